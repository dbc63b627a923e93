"""Secret scans over a ledger of content-addressed blobs. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewheel.plans.skew import dealt_join, shuffle_parts
from tidewheel.plans.storage import materialize

from .arrays import bound, in_blocks, running

#: kind -> (rule version, pattern, group whose length counts, least length), in the order of
#: ties. Fixed values. The class-only patterns carry their least length themselves: a run
#: that is too short can't hold a longer match of the same class.
RULES = {
    "assign": (1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (1, r"[0-9a-f]{24,}", 0, 24),
}
SPAN = "array<struct<start:long,kind:int,name:string,end:long>>"
LEDGER = f"blob binary, rule string, version int, spans {SPAN}"


def blob_of(text: Column) -> Column:
    """Content address: SHA-256, as bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def spans_of(text: Column, kind: str, rules: dict = RULES) -> Column:
    """Matches of one rule, leftmost first and not overlapping, as array<struct<start, kind, name, end>> in code points.

    Splitting by the pattern gives the texts between matches; their lengths and the
    matches' lengths place every match.
    """
    _, pattern, group, least = rules[kind]
    order = list(rules).index(kind)
    empty = F.array().cast(SPAN)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = lambda x: F.struct(F.length(x["gap"]).cast("long").alias("gap"), F.length(x["hit"]).cast("long").alias("hit"), (F.length(F.regexp_extract(x["hit"], pattern, group)) >= least).alias("ok"))
    steps = bound(found, lambda hits: F.transform(F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(hits)).alias("gap"), hits.alias("hit")), lengths))

    def add(s: Column, x: Column) -> Column:
        start, end = s["at"] + x["gap"], s["at"] + x["gap"] + x["hit"]
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), F.lit(kind).alias("name"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(x["ok"], F.concat(s["spans"], F.array(span).cast(SPAN))).otherwise(s["spans"]).alias("spans"))

    def place(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, x: s + x["gap"] + x["hit"]))
        zipped = F.arrays_zip(blocks.alias("steps"), running(sums, lambda s, x: s + x).alias("start"))
        return F.flatten(F.transform(zipped, lambda z: F.aggregate(z["steps"], F.struct(z["start"].alias("at"), empty.alias("spans")), add, lambda s: s["spans"])))

    return F.when(F.regexp_like(text, F.lit(pattern)), bound(bound(steps, in_blocks), place)).otherwise(empty)


def cut_out(text: Column, spans: Column, mark: str) -> Column:
    """text with its spans (sorted by start) replaced by mark; overlapping spans are replaced as one."""

    def pieces(z: Column) -> Column:
        def of(region: Column) -> Column:
            def add(s: Column, x: Column) -> Column:
                gap = F.substring(region, (s["at"] - z["low"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
                more = F.when(x["start"] >= s["at"], F.concat(s["out"], F.array(gap, F.lit(mark)))).otherwise(s["out"])
                return F.when(x["end"] <= s["at"], s).otherwise(F.struct(x["end"].alias("at"), more.alias("out")))

            return F.aggregate(z["spans"], F.struct(z["low"].alias("at"), F.array().cast("array<string>").alias("out")), add, lambda s: s["out"])

        return bound(F.substring(text, (z["low"] + 1).cast("int"), (z["high"] - z["low"]).cast("int")), of)

    def joined(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, x: F.greatest(s, x["end"])))
        low = running(ends, F.greatest)
        high = F.transform(F.arrays_zip(low.alias("low"), ends.alias("end")), lambda x: F.greatest(x["low"], x["end"]))
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("spans"), low.alias("low"), high.alias("high")), pieces))

    last = F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: F.greatest(s, x["end"]))
    return F.concat(F.array_join(bound(in_blocks(spans), joined), ""), F.substring(text, (last + 1).cast("int"), F.length(text)))


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then kind."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def current_rules(rules: dict = RULES) -> Column:
    return F.array(*(F.lit(f"{k}@{v[0]}") for k, v in rules.items()))


def new_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def unseen_blobs(versions: DataFrame, ledger: DataFrame, rules: dict = RULES) -> DataFrame:
    """(blob, text, todo): one row for each distinct text, with the rules whose current version hasn't seen it.

    Copies are reduced to one row before the shuffle, so a text that a third of all paths
    hold costs one row a task.
    """
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    seen = ledger.groupBy(F.col("blob").alias("seen_blob")).agg(F.collect_set(F.concat_ws("@", "rule", F.col("version").cast("string"))).alias("done"))
    left = blobs.join(seen, F.col("blob") == F.col("seen_blob"), "left")
    return left.select("blob", "text", F.array_except(current_rules(rules), F.coalesce("done", F.array().cast("array<string>"))).alias("todo")).where(F.size("todo") > 0)


def scan(text: Column, todo: Column, rules: dict = RULES) -> Column:
    """Spans of all rules in ``todo``; the others don't run."""
    empty = F.array().cast(SPAN)
    return F.array_sort(F.concat(*(F.when(F.array_contains(todo, f"{k}@{v[0]}"), spans_of(text, k, rules)).otherwise(empty) for k, v in rules.items())))


def scan_blobs(unseen: DataFrame, rules: dict = RULES) -> DataFrame:
    """(blob, todo, spans): each rule runs on the blobs that it hasn't seen, and only there."""
    return unseen.select("blob", "todo", scan(F.col("text"), F.col("todo"), rules).alias("spans"))


def ledger_entries(unseen: DataFrame, rules: dict = RULES) -> DataFrame:
    """The ledger rows that a scan of ``unseen`` adds: the spans of each blob under each rule that ran, also where there are none."""
    pair = F.split(F.col("pair"), "@")
    ran = scan_blobs(unseen, rules).select("blob", "spans", F.explode("todo").alias("pair"))
    return ran.select("blob", pair[0].alias("rule"), pair[1].cast("int").alias("version"), F.filter("spans", lambda s: s["name"] == pair[0]).alias("spans"))


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None, rules: dict = RULES, id_col: str = "doc_id", text_col: str = "text", save_to: str | None = None) -> DataFrame:
    """(doc_id, spans) of every row under all current rules, wherever its text was scanned first.

    Only the unseen blob and rule-version pairs are scanned. Their ledger rows are written to the
    shared folder, and appended to ``save_to`` if given, which a later scan takes as its
    ledger; then they and the ledger's earlier rows of the current versions are joined back to
    all paths. Null text counts as
    empty. Null ids, repeated ids and repeated rows each come back once a row. Extra columns are ignored.
    """
    spark = versions.sparkSession
    v = versions.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("blob", blob_of(F.col("text")))
    known = ledger if ledger is not None else new_ledger(spark)
    added = materialize(ledger_entries(unseen_blobs(v, known, rules), rules), "secret-ledger")  # a side of its own, so a blob that many paths hold can be split in the join
    if save_to:
        added.write.mode("append").parquet(save_to)
    current = known.where(F.concat_ws("@", "rule", F.col("version").cast("string")).isin([f"{k}@{r[0]}" for k, r in rules.items()])).select("blob", "rule", "spans")
    found = added.select("blob", "rule", "spans").unionByName(current).where(F.size("spans") > 0).groupBy("blob", "rule").agg(F.first("spans").alias("spans"))
    hits = found.groupBy(F.col("blob").alias("hit_blob")).agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    return dealt_join(v.select("id", "blob"), hits, "blob", "hit_blob", "left").select(F.col("id").alias(id_col), F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def findings(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of ``scan_versions``."""
    n = lambda kind: F.size(F.filter("spans", lambda s: s["name"] == kind)).cast("long")
    return scanned.select(id_col, n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"), F.sha2(digest(F.col("spans")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def hot_texts(keys: DataFrame, parts: int) -> DataFrame:
    """(hot) keys of ``keys`` (key, bytes) that hold over 1/(4 parts) of all rows or of all bytes: fewer than 8 parts, whatever the input."""
    sums = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b"))
    over = lambda c: F.col(c) * (4 * parts) > sums.agg(F.sum(c)).scalar()
    return sums.where((F.col("n") > 1) & (over("n") | over("b"))).select(F.col("key").alias("hot"))


def redact(docs: DataFrame, mark: str = "[secret]", text_col: str = "text", ledger: DataFrame | None = None, rules: dict = RULES) -> DataFrame:
    """docs with every secret replaced by ``mark``; overlapping spans are replaced as one. Columns and rows stay.

    Only the blob and rule-version pairs that ``ledger`` (see ``scan_versions``) lacks are
    scanned; its findings serve for the others. Every row is kept, also repeated rows and null
    ids; null text stays null. Texts move once, to their content address: the first row there
    is scanned, and a window brings its findings to the others. Rows of a hot text are dealt
    into as many parts as a shuffle has, by a hash of their other columns, and each part scans it
    once; only rows equal in all columns stay together.
    """
    parts = shuffle_parts(docs)
    own = "_" * (1 + max(map(len, docs.columns)))  # longer than any column, so no name clashes
    key, hot, blob, part, todo, cuts, old, blob2, part2 = (own + x for x in ("key", "hot", "blob", "part", "todo", "cuts", "old", "blob2", "part2"))
    text, whole = F.col(text_col), F.coalesce(F.col(text_col), F.lit(""))
    others = [F.col(c) for c, kind in docs.dtypes if c != text_col and "map<" not in kind and "variant" not in kind]
    few = F.broadcast(hot_texts(docs.select(F.xxhash64(whole).alias("key"), F.octet_length(whole).cast("long").alias("bytes")), parts).withColumnRenamed("hot", hot))
    dealt = docs.withColumns({key: F.xxhash64(whole), blob: blob_of(text)}).join(few, F.col(key) == F.col(hot), "left")
    dealt = dealt.withColumn(part, F.when(F.col(hot).isNotNull(), F.pmod(F.xxhash64(*others, F.lit(0)), F.lit(parts))).otherwise(F.lit(0)).cast("int"))
    if ledger is None:
        dealt = dealt.withColumns({todo: current_rules(rules), old: F.array().cast(SPAN)})
    else:  # the ledger's rows of a hot text go to each of its parts; join and window share one exchange
        rule = F.concat_ws("@", "rule", F.col("version").cast("string"))
        known = ledger.where(rule.isin([f"{k}@{r[0]}" for k, r in rules.items()])).select("blob", rule.alias("rule"), "spans").groupBy("blob", "rule").agg(F.first("spans").alias("spans"))
        known = known.groupBy(F.col("blob").alias(blob2)).agg(F.collect_list("rule").alias(todo), F.flatten(F.collect_list("spans")).alias(old))
        spread = dealt.where(F.col(hot).isNotNull()).select(F.col(blob).alias("hot_blob")).distinct()
        known = known.join(F.broadcast(spread), F.col(blob2) == F.col("hot_blob"), "left")
        known = known.withColumn(part2, F.explode(F.when(F.col("hot_blob").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(parts - 1))))).drop("hot_blob")
        dealt = dealt.join(known, (F.col(blob) == F.col(blob2)) & (F.col(part) == F.col(part2)), "left")
        dealt = dealt.withColumns({todo: F.array_except(current_rules(rules), F.coalesce(todo, F.array().cast("array<string>"))), old: F.coalesce(old, F.array().cast(SPAN))})
    copies = Window.partitionBy(blob, part).orderBy(blob)
    dealt = dealt.withColumn(todo, F.when(F.row_number().over(copies) == 1, F.col(todo)))
    scanned = dealt.withColumn(cuts, F.when(F.col(todo).isNotNull(), F.array_sort(F.concat(old, scan(whole, F.col(todo), rules)))))
    found = scanned.withColumn(cuts, F.first(cuts).over(copies.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return found.withColumn(text_col, F.when(F.size(cuts) > 0, cut_out(text, F.col(cuts), mark)).otherwise(text)).select(*docs.columns)
