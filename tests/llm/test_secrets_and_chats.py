import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from tidewheel.llm import preferences, secrets
from tidewheel.llm.queries import ORACLE

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
TEXTS = [
    None, "", "nothing", 'password = "hunter2a" and é token:abc', "API_KEY=abcdef123 apikey: 'zz9/+=-_.x'", "token:token:abcdef", "secret = short", "AKIA" + "A1" * 8 + " AKIAshort AKIAB",
    "deadbeef" * 3 + "0" + " deadbeef", "x" * 500 + "token=" + "0a" * 13 + "\n漢" + "f" * 24, "passwdpasswd=1234567 AKIAAKIA" + "Z" * 16, "password=AKIA" + "Q" * 20 + "deadbeefdeadbeefdeadbeef",
]


def _spans(t):
    t = t or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def _docs(spark):
    rows = [(i, t, 5) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 5), (None, TEXTS[3], 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans int")


def test_scan(spark):
    docs = _docs(spark)
    got = sorted((tuple(r) for r in secrets.findings(secrets.scan_versions(docs)).collect()), key=str)
    want = []
    for i, t in [*enumerate(TEXTS), (3, TEXTS[3]), (None, TEXTS[3])]:
        s = _spans(t)
        text = ",".join(f"{k}:{a}:{z}" for a, _, k, z in s)
        want.append((i, *(sum(x[2] == k for x in s) for k in ("assign", "access", "hex")), hashlib.sha256(text.encode()).hexdigest(), text))
    assert got == sorted(want, key=str)
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    sql = con.execute(ORACLE["op5_secret_scan"]).fetchall()
    assert sorted([tuple(r) for r in sql], key=str) == sorted(want, key=str)
    assert secrets.findings(secrets.scan_versions(docs.limit(0))).count() == 0


def test_ledger_scans_only_unseen_pairs(spark):
    docs = _docs(spark).withColumn("blob", secrets.blob_of(F.col("text")))
    v = docs.select("blob", F.coalesce("text", F.lit("")).alias("text"))
    first = secrets.unseen_blobs(v, secrets.new_ledger(spark))
    assert first.count() == len(set(t or "" for t in TEXTS))
    ledger = secrets.ledger_entries(first)
    assert secrets.unseen_blobs(v, ledger).count() == 0
    newer = secrets.RULES | {"hex": (2, *secrets.RULES["hex"][1:])}
    again = secrets.scan_blobs(secrets.unseen_blobs(v, ledger, newer), newer).collect()
    assert {tuple(r.todo) for r in again} == {("hex@2",)}
    assert {s.name for r in again for s in r.spans} == {"hex"}


def test_second_scan_finds_old_blobs_under_new_paths(spark, tmp_path):
    docs, path = _docs(spark), f"file://{tmp_path}/ledger"
    want = {r.doc_id: r.spans for r in secrets.scan_versions(docs, save_to=path).where("doc_id IS NOT NULL").collect()}
    more = docs.where("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id") + 100)
    newer = secrets.RULES | {"hex": (2, *secrets.RULES["hex"][1:])}
    for rules in (secrets.RULES, newer):
        got = secrets.scan_versions(more, spark.read.parquet(path), rules, save_to=path).collect()
        assert {r.doc_id - 100: r.spans for r in got} == want and any(want.values())
    assert spark.read.parquet(path).groupBy("blob", "rule", "version").count().where("count > 1").count() == 0


def test_redaction(spark):
    docs = _docs(spark)
    out = secrets.redact(docs, "[x]")
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.where("doc_id IS NOT NULL").collect():
        t = TEXTS[r.doc_id]
        if t is None:
            assert r.text is None
            continue
        want, at = "", 0
        for a, _, _, z in _spans(t):
            if z <= at:
                continue
            want += (t[at:a] + "[x]") if a >= at else ""
            at = z
        assert r.text == want + t[at:]


def test_redaction_of_a_hot_text(spark):
    text = "token=abcdef1 " + "é" * 50
    rows = [(i if i % 7 else None, text if i % 3 == 0 else None if i % 3 == 1 else f"secret: {i:06d}", i % 5) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __blob int").repartition(6)
    want = [(i, t if t is None else "[secret] " + "é" * 50 if t == text else "[secret]", b) for i, t, b in rows]
    assert sorted((tuple(r) for r in secrets.redact(docs).collect()), key=str) == sorted(want, key=str)
    keys = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), F.lit(1).cast("long").alias("bytes"))
    assert secrets.hot_texts(keys, 8).count() == 2  # the copies and the nulls
    assert secrets.redact(docs.limit(0)).count() == 0
    assert secrets.redact(docs.select("text")).count() == 600


CHATS = [(0, 0, "system", "be kind"), (0, 1, "user", "hi é"), (0, 2, "assistant", "hello"), (0, 3, "user", "bye"), (1, 0, "user", "hi"), (1, 1, "assistant", "other"), (1, 1, "assistant", "other"), (2, 0, "user", "no reply"), (4, 0, None, None), (4, 1, "assistant", "same"), (5, 1, "assistant", "same"), (None, 0, "user", "x"), (6, None, "user", "x")] + [
    (8, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(150)
] + [(9, 1, "assistant", "end")]


def test_preferences(spark):
    chats = spark.createDataFrame([(*r, "z") for r in CHATS], "conv_id long, turn long, role string, text string, body string")
    rows = preferences.preference_format(*preferences.swapped_replies(chats)).collect()
    by = {r.pair_id: r for r in rows}
    assert sorted(by) == [0, 1, 4, 5, 8, 9] and len(rows) == 6
    assert by[0].prompt == "<|system|>\nbe kind\n<|user|>\nhi é\n"
    assert by[0].chosen == "<|assistant|>\nhello\n" and by[0].rejected == "<|assistant|>\nother\n"  # cut alike: the turn after the last reply goes
    a, z = map(int, by[0].chosen_loss.split(":"))
    assert by[0].chosen[a:z] == "hello" and by[0].rejected[slice(*map(int, by[0].rejected_loss.split(":")))] == "other"
    assert by[4].chosen == by[4].rejected == "" and by[4].prompt.endswith("<|assistant|>\nsame\n")
    assert by[9].rejected == "<|assistant|>\nhello\n"  # after the last comes the first
    assert by[8].prompt.count("<|user|>") == 75 and by[8].chosen == "<|assistant|>\nt149\n"
    con = duckdb.connect()
    con.register("conversations", chats.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    assert sorted(con.execute(ORACLE["op6_preference_format"]).fetchall()) == sorted(tuple(r) for r in rows)
    assert preferences.preference_format(*preferences.swapped_replies(chats.where("conv_id = 0"))).count() == 0
    assert preferences.preference_format(*preferences.swapped_replies(chats.limit(0))).count() == 0


def test_redaction_by_a_ledger(spark, tmp_path):
    docs, path = _docs(spark), f"file://{tmp_path}/ledger"
    secrets.scan_versions(docs.where("doc_id < 6"), save_to=path).count()
    newer = secrets.RULES | {"hex": (2, *secrets.RULES["hex"][1:])}
    for rules in (secrets.RULES, newer):
        want = sorted((tuple(r) for r in secrets.redact(docs, "[x]").collect()), key=str)
        assert sorted((tuple(r) for r in secrets.redact(docs, "[x]", ledger=spark.read.parquet(path), rules=rules).collect()), key=str) == want
    fake = spark.read.parquet(path).where("false").union(spark.createDataFrame([(hashlib.sha256(b"nothing").digest(), k, 1, []) for k in ("access", "hex")] + [(hashlib.sha256(b"nothing").digest(), "assign", 1, [(0, 0, "assign", 3)])], secrets.LEDGER))
    hot = spark.createDataFrame([(i, "nothing") for i in range(50)] + [(99, "token=abcdef1")], "doc_id long, text string")
    assert sorted(r.text for r in secrets.redact(hot, "[x]", ledger=fake).collect()) == ["[x]"] + ["[x]hing"] * 50  # stored findings are used, not made again


def test_many_secrets_in_one_text(spark):
    import time

    text = "é token=abcdef1 and " * 100_000 + "end"
    docs = spark.createDataFrame([(1, text), (2, "x"), (3, text)], "doc_id long, text string")
    began = time.monotonic()
    got = {r.doc_id: r for r in secrets.findings(secrets.scan_versions(docs)).collect()}
    assert got[1].n_assign == got[3].n_assign == 100_000 and got[2].n_assign == 0
    assert got[1].spans == ",".join(f"assign:{20 * i + 2}:{20 * i + 15}" for i in range(100_000))
    assert {r.doc_id: r.text for r in secrets.redact(docs).collect()} == {1: "é [secret] and " * 100_000 + "end", 2: "x", 3: "é [secret] and " * 100_000 + "end"}
    assert time.monotonic() - began < 100


def test_preferences_that_part_early(spark):
    turns = lambda t, n: [(1, i, "assistant" if i % 2 else "user", f"{t if i >= 3 else ''}é{i}") for i in range(n)]
    kind = "pair_id long, turn long, role string, text string"
    a, b = turns("a", 200), turns("b", 130)
    got = preferences.preference_format(spark.createDataFrame([*a, (2, 0, "user", "only here")], kind), spark.createDataFrame(b, kind)).collect()
    text = lambda rows: "".join(f"<|{r}|>\n{t}\n" for _, _, r, t in rows)
    one, two = sorted(got)
    assert (one.prompt, one.chosen, one.rejected) == (text(a[:3]), text(a[3:]), text(b[3:]))
    assert [one.chosen[slice(*map(int, s.split(":")))] for s in one.chosen_loss.split(",")] == [t for _, _, r, t in a[3:] if r == "assistant"]
    assert [one.rejected[slice(*map(int, s.split(":")))] for s in one.rejected_loss.split(",")] == [t for _, _, r, t in b[3:] if r == "assistant"]
    assert (two.prompt, two.chosen, two.rejected, two.chosen_loss) == ("", "<|user|>\nonly here\n", "", "")
