"""tidewheel: trip and station analytics written as PySpark DataFrame plans."""
