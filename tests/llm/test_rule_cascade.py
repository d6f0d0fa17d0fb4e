"""The cascade: base counts by plain Python, order of the rules by cost and rejections."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from presslake.llm.rule_cascade import Rule, cascade, default_rules, measure, op5_quality_rules, quality_cascade, with_counts

SF = "/root/testdata/sf0.001"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = len({i + k for i, w in enumerate(windows) if w in twice for k in range(3)})
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeated, n < 50 or 100 * repeated > 50 * n)


def texts():
    dice = random.Random(4)
    prose = [" ".join(dice.choices(["the", "and", "of", *(f"w{i}" for i in range(200))], k=dice.randrange(40, 120))) for _ in range(40)]
    odd = [None, "", " \n\t", "one", "a b c " * 30, "\n".join(["line one here", "line two"] * 20), "x" * 200_000, "# $ % & | < > * " * 20, "É! " * 60, "the " + "lang " * 40_000]
    return prose + odd + prose[:3]


def frame(spark):
    rows = [(None if i == 7 else i % 45, t, "mine", 1, "c") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, words string, n_words int, kept string")


def test_rows_of_every_kind(spark):
    found = quality_cascade(frame(spark)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = Counter((r.doc_id, *(r[n] for n in names)) for r in found)
    assert got == Counter((None if i == 7 else i % 45, *plain(t)) for i, t in enumerate(texts()))
    assert all(r.kept == (not r.base_failed and r.rejected_by is None) for r in found)
    assert quality_cascade(frame(spark).limit(0)).count() == 0


def test_any_order_gives_the_same_verdict(spark):
    judged, rules = with_counts(frame(spark)), default_rules()
    one, two = (judged.withColumn("by", cascade(r)).select("doc_id", "text", F.col("by").isNull().alias("kept")) for r in (rules, rules[::-1]))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))


def test_a_slow_rule_comes_last_and_a_cheap_one_first(spark):
    sample = with_counts(spark.range(400).select(F.concat(F.lit("word "), "id").alias("text"), "id"))
    slow = F.aggregate(F.sequence(F.lit(1), F.lit(3000)), F.col("id"), lambda a, x: (a * 31 + x) % 1_000_003) % 100 < 20
    rules = [
        Rule("slow", slow), Rule("rare", F.col("id") % 50 == 49), Rule("cheap", F.col("id") % 2 == 0),
        Rule("covered", (F.col("id") % 2 == 0) & (F.col("id") % 3 > 0)), Rule("never", F.col("id") < 0),
    ]
    for _ in range(5):
        found = [r.name for r in measure(rules, sample)]
        assert found[0] == "cheap" and found.index("slow") > found.index("rare")
        shares = {r.name: r.share for r in measure(rules, sample)}
        assert shares["covered"] == 0.0 and shares["cheap"] == 0.5  # what the cheap one rejects is gone already


def test_given_documents(spark):
    got = {r.doc_id: tuple(r)[1:7] for r in op5_quality_rules(spark, SF).collect()}
    assert got == {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
