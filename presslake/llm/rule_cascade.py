"""Quality rules as a short-circuit cascade.

Each rule rejects a document by a condition on counts. What a rule costs and how many rows it rejects is
estimated on a bounded sample; rules then stand in the order of rejections per cost, and a ``CASE`` stops at the
first that rejects. The order changes the work, never the verdict.
"""

from __future__ import annotations

import statistics
import time
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import SPACE, WORD, let, settled, table, whole_text, written
from presslake.llm.registry import query

#: Rows of the sample that rules are timed on, at most about this many.
SAMPLE_ROWS = 2000
#: Runs of a timing that count, how often each row is judged in one, and what must be seen beside an idle job.
RUNS, JUDGED_TIMES, LEAST_SECONDS = 3, (1, 8, 64), 0.05

# Function words of the four languages; a text of 50 words or more has some of them.
FUNCTION_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "with", "der", "die", "das", "und", "den", "von", "ist",
    "mit", "le", "la", "les", "de", "des", "et", "que", "un", "une", "el", "los", "en", "y", "del", "con",
]


@dataclass(frozen=True)
class Rule:
    """Rejects a row where ``reject`` is true; ``cost`` (seconds) and ``share`` (rejected) come from a sample."""

    name: str
    reject: Column
    cost: float = 0.0
    share: float = 0.0

    @property
    def worth(self) -> float:
        return self.share / max(self.cost, 1e-9)


def words_of(text: Column) -> Column:
    """Words in order; no word is empty."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """How many words stand in a window of ``width`` words that the text holds twice or more.

    Windows are sorted by a 32-bit hash with their place in the low bits; those with an equal neighbour are then
    sorted by their words. So the work is n log n for any text, and a hash collision changes nothing.
    """
    def window(w: Column, i: Column) -> list[Column]:
        return [F.get(w, i + k) for k in range(width)]

    def has_twin(xs: Column, part) -> Column:
        def near(x: Column, i: Column) -> Column:
            before = (i > 0) & (part(F.get(xs, i - 1)) == part(x))
            return F.coalesce(before, F.lit(False)) | F.coalesce(part(F.get(xs, i + 1)) == part(x), F.lit(False))
        return F.filter(xs, near)

    def exact(w: Column, keys: Column) -> Column:
        places = F.transform(keys, lambda k: k.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
        named = F.transform(places, lambda i: F.struct(F.concat_ws(" ", *window(w, i)).alias("s"), i.alias("i")))
        return let(F.sort_array(named), lambda xs: covered(has_twin(xs, lambda x: x["s"])))

    def covered(twins: Column) -> Column:
        places = F.sort_array(F.transform(twins, lambda x: x["i"]))
        return let(places, lambda p: F.coalesce(F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width)))),
            F.lit(0).cast("bigint"), lambda a, b: a + b.cast("bigint"),
        ), F.lit(0).cast("bigint")))

    def count(w: Column) -> Column:
        keys = F.transform(
            F.sequence(F.lit(0), F.size(w) - width),
            lambda i: F.shiftleft(F.hash(*window(w, i)).cast("bigint"), 32).bitwiseOR(i.cast("bigint")),
        )
        twins = let(F.sort_array(keys), lambda ks: has_twin(ks, lambda k: F.shiftright(k, 32)))
        return F.when(F.size(w) <= width, F.lit(0).cast("bigint")).otherwise(
            let(twins, lambda ks: F.when(F.size(ks) == 0, F.lit(0).cast("bigint")).otherwise(exact(w, ks)))
        )

    return count(words)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds what the rules look at: words, lines and the base counts. Null text counts as empty."""
    whole = whole_text(text)
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(rf"[^{SPACE}]"))
    shaped = settled(docs, {"words": words_of(whole), "lines": lines})
    counted = settled(shaped, {
        "n_words": F.size("words").cast("bigint"),
        "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
        "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("bigint"),
        "n_lines": F.size("lines").cast("bigint"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "n_repeat_words": repeated_window_words(F.col("words")),
    })
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def default_rules(text: str = "text") -> list[Rule]:
    """Production rules over the columns of ``with_counts``."""
    whole, words, n = whole_text(text), F.col("words"), F.col("n_words")
    shouted = F.regexp_count(whole, F.lit("[A-ZÀ-ÖØ-Þ]"))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("repeated lines", (F.col("n_dup_lines") >= 3) & (100 * F.col("n_dup_lines") > 30 * F.col("n_lines"))),
        Rule("word length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
        Rule("capitals", 100 * shouted > 30 * F.col("word_chars")),
        Rule("exclamation marks", 100 * F.regexp_count(whole, F.lit("!")) > 20 * n),
        Rule("no function words", ~F.arrays_overlap(
            F.transform(words, lambda w: F.lower(w)), F.array(*[F.lit(w) for w in FUNCTION_WORDS])
        )),
    ]


def seconds_of(sample: DataFrame, conditions: list[Column]) -> list[float]:
    """What each condition takes over the sample once, less what the same job takes without one.

    Every row is judged several times in its task, as often as it takes to see the condition beside the cost of a job;
    the first run of each only warms up, and the median of the others counts. Conditions too cheap to be seen cost the
    same, so that they come in order of their rejections.
    """
    def median_run(condition: Column, times: int) -> float:
        again = sample.withColumn("__again", F.explode(F.sequence(F.lit(1), F.lit(times))))
        job, taken = again.agg(F.count_if(condition)), []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            job.first()
            taken.append(time.perf_counter() - start)
        return statistics.median(taken[1:])

    idle: dict[int, float] = {}
    found = []
    for condition in conditions:
        for times in JUDGED_TIMES:
            if times not in idle:
                idle[times] = median_run(F.col("__again") < 0, times)
            spent = median_run(condition, times) - idle[times]
            if spent >= LEAST_SECONDS:
                break
        found.append(max(spent, LEAST_SECONDS) / times)
    return found


def measure(rules: list[Rule], sample: DataFrame) -> list[Rule]:
    """The rules in order of rejections per cost, with cost and share of rejected rows.

    The share of a rule is that among the rows which the rules before it leave, so a rule that rejects what another
    has rejected already comes late. Ties go to the cheaper rule, then by name.
    """
    said = F.concat(*[F.coalesce(r.reject, F.lit(False)).cast("int").cast("string") for r in rules])
    left = {r.said: r.n for r in sample.groupBy(said.alias("said")).agg(F.count("*").alias("n")).collect()}  # at most a row for each of the sample
    costs = dict(zip(range(len(rules)), seconds_of(sample, [r.reject for r in rules]), strict=True))
    found = []
    while costs:
        rows = sum(left.values())
        open_ = [replace(rules[i], cost=c, share=sum(n for s, n in left.items() if s[i] == "1") / rows if rows else 0.0) for i, c in costs.items()]
        best = min(zip(costs, open_, strict=True), key=lambda x: (-x[1].worth, x[1].cost, x[1].name))
        found.append(best[1])
        del costs[best[0]]
        left = {s: n for s, n in left.items() if s[best[0]] == "0"}
    return found


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, or null. Later rules aren't evaluated."""
    first = F
    for rule in rules:
        first = first.when(F.coalesce(rule.reject, F.lit(False)), F.lit(rule.name))
    return first.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def quality_cascade(
    docs: DataFrame, text: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Every row of ``docs`` with its counts, ``base_failed``, ``rejected_by`` and ``kept``.

    A row is kept if the base limits hold and no rule rejects it. Null and empty texts have no words and fail the
    base limits; repeated rows are judged each alike; an empty table gives no rows. Columns of the input with the
    name of a result column are replaced, other columns pass through.
    """
    rules = default_rules(text) if rules is None else rules
    total = docs.count()
    if rules and total:
        share = min(1.0, 1.2 * sample_rows / total)
        rules = measure(rules, written(with_counts(docs.sample(share, seed=7), text), "rule-sample"))
    judged = with_counts(docs, text)
    verdict = F.when(~F.col("base_failed"), cascade(rules))
    judged = judged.withColumn("rejected_by", verdict)
    kept = ~F.col("base_failed") & F.col("rejected_by").isNull()
    return judged.withColumn("kept", kept).drop("words", "lines", "n_lines")


# DuckDB: the same counts, and the production rules as one condition.
SQL = r"""
with d as (select doc_id, coalesce(text, '') as t, row_number() over () as row_no from documents),
w as (select *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
c as (select row_no, doc_id, t, words, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(lines) as n_lines,
    len(lines) - len(list_distinct(lines)) as n_dup_lines from w),
win as (select row_no, unnest(range(0, greatest(n_words - 2, 0))) as i, words from c),
named as (select row_no, i, words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3] as s from win),
twice as (select row_no, i from named qualify count(*) over (partition by row_no, s) > 1),
rep as (select row_no, count(distinct i + k) as n from twice, (values (0), (1), (2)) as v(k) group by row_no),
j as (select c.*, coalesce(rep.n, 0) as n_repeat_words,
    n_words < 50 or 100 * coalesce(rep.n, 0) > 50 * n_words as base_failed from c left join rep using (row_no))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
    n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
    not (base_failed or 10 * n_symbols > n_words or (n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines)
        or word_chars < 2 * n_words or word_chars > 20 * n_words
        or 100 * length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) > 30 * word_chars
        or 100 * length(regexp_replace(t, '[^!]', '', 'g')) > 20 * n_words
        or not list_has_any(list_transform(words, lambda x: lower(x)), [{words}])) as kept
from j
""".replace("{words}", ", ".join(f"'{w}'" for w in FUNCTION_WORDS))


@query("op5_quality_rules", SQL)
def op5_quality_rules(spark, sf_dir):
    judged = quality_cascade(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
