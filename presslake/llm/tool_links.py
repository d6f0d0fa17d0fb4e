"""Chat formatting: tool calls linked to results, ordered, validated and written as canonical JSON.

All of it is DataFrame work. Calls and results meet by a hash join on (conversation, identifier). Calls are placed in
rounds: those whose needed calls are all placed come next; calls that need each other in a ring are never placed.
Arguments are parsed once; a parsed object keeps its keys in order, so writing it again gives canonical JSON.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import WORD, settled, table, whole_text, written
from presslake.llm.registry import query


@dataclass(frozen=True)
class Parameter:
    """What a tool's schema says of one argument; ``kind`` is integer, number, string, boolean, array or object."""

    name: str
    kind: str
    required: bool = True
    least: float | None = None
    most: float | None = None
    choices: tuple[str, ...] = ()


# Names that the parsed value's schema begins with, by kind of argument.
_KINDS = {
    "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "string": ["STRING"], "boolean": ["BOOLEAN"],
    "array": ["ARRAY"], "object": ["OBJECT"],
}


def _faults(arguments: Column, parameter: Parameter) -> list[Column]:
    """One column per demand: a message where it is not met, else null."""
    path = f"$['{parameter.name}']"
    value = F.try_variant_get(arguments, path, "variant")
    kind = F.schema_of_variant(value)
    given = value.isNotNull() & (kind != "VOID")
    fits = F.lit(False)
    for start in _KINDS[parameter.kind]:
        fits |= kind.startswith(start)
    found = [F.when(given & ~fits, F.lit(f"{parameter.name}: not {parameter.kind}"))]
    if parameter.required:
        found.append(F.when(~F.coalesce(given, F.lit(False)), F.lit(f"{parameter.name}: missing")))
    number = F.try_variant_get(arguments, path, "double")
    if parameter.least is not None:
        found.append(F.when(given & fits & (number < parameter.least), F.lit(f"{parameter.name}: too small")))
    if parameter.most is not None:
        found.append(F.when(given & fits & (number > parameter.most), F.lit(f"{parameter.name}: too large")))
    if parameter.choices:
        text = F.try_variant_get(arguments, path, "string")
        found.append(F.when(given & fits & ~text.isin(*parameter.choices), F.lit(f"{parameter.name}: not a choice")))
    return found


def schema_faults(name: Column, arguments: Column, canonical: Column, schemas: dict[str, list[Parameter]]) -> Column:
    """All faults of a call's arguments, in order; an array."""
    faults = [F.when(arguments.isNull(), F.lit("not a JSON object"))]
    faults.append(F.when(~F.coalesce(name.isin(*schemas), F.lit(False)), F.lit("unknown tool")))
    for tool, parameters in schemas.items():
        known = F.array(*[F.lit(p.name) for p in parameters]).cast("array<string>")
        extra = F.array_sort(F.array_except(F.json_object_keys(canonical), known))
        mine = [F.when(F.size(extra) > 0, F.concat_ws(" ", F.lit("unknown arguments"), F.array_join(extra, " ")))]
        for parameter in parameters:
            mine += _faults(arguments, parameter)
        faults += [F.when((name == tool) & arguments.isNotNull(), fault) for fault in mine]
    return F.array_compact(F.array(*faults))


def order_calls(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, level)``: the round a call can run in, null in a ring. ``calls`` has ``needs``.

    Needed calls that the conversation doesn't have are ignored. Where no call needs two others the levels come from
    doubling: rounds grow with the logarithm of the longest chain. Else they are as many as that chain is long.
    """
    ids = ["conv_id", "call_id"]
    known = written(calls.select(*ids).where("call_id is not null").distinct(), "calls")
    needs = calls.select(*ids, F.explode("needs").alias("need")).where("need is not null").distinct()
    have = known.select(F.col("conv_id").alias("c"), F.col("call_id").alias("n"))
    there = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("need") == F.col("n"))
    waits = written(needs.join(have, there, "left_semi"), "needs")
    if waits.groupBy(*ids).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return _levels_by_doubling(known, waits)
    left, placed, level = known, None, 0
    while not left.isEmpty():
        blocked = waits.select(F.col("conv_id").alias("c"), F.col("call_id").alias("n")).distinct()
        same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("n"))
        ready = written(left.join(blocked, same, "left_anti"), "ready")
        if ready.isEmpty():
            break
        now = ready.withColumn("level", F.lit(level))
        placed = now if placed is None else placed.unionByName(now)
        done = ready.select(F.col("conv_id").alias("c"), F.col("call_id").alias("n"))
        left = written(left.join(done, same, "left_anti"), "left")
        waits = written(waits.join(done, there, "left_anti"), "needs")
        level += 1
    rest = left.withColumn("level", F.lit(None).cast("int"))
    return rest if placed is None else placed.unionByName(rest)


def _levels_by_doubling(known: DataFrame, needs: DataFrame) -> DataFrame:
    """Levels where every call has one need at most: each round a call looks twice as far up its chain.

    A call whose chain has not ended after as many rounds as the number of calls has binary digits is in a ring or
    leads to one.
    """
    up = needs.select(F.col("conv_id").alias("c"), F.col("call_id").alias("n"), F.col("need").alias("up"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("n"))
    state = known.join(up, same, "left").select("conv_id", "call_id", "up", F.col("up").isNotNull().cast("int").alias("level"))
    state = written(state, "levels")
    for _ in range(known.count().bit_length() + 1):
        if state.where("up is not null").isEmpty():
            break
        there = state.where("up is not null").select("conv_id", "call_id", F.col("up").alias("at"), "level")
        far = state.select(F.col("conv_id").alias("c"), F.col("call_id").alias("n"), "up", F.col("level").alias("more"))
        met = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("n"))
        moved = there.join(far, met).select("conv_id", "call_id", "up", (F.col("level") + F.col("more")).alias("level"))
        state = written(state.where("up is null").unionByName(moved), "levels")
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, list[Parameter]]) -> DataFrame:
    """Calls ``(conv_id, turn, call_id, name, arguments, needs)`` with results ``(conv_id, turn, call_id, content)``.

    One row per call, one per result that no call asked for and one per further result of an identifier: ``conv_id,
    turn, call_id, level, result_turn, status, valid, faults, json``. ``status`` is linked, unanswered, orphan or
    repeated. A call that repeats an identifier is a fault of each such call; of several results to one identifier the
    first by turn and content is linked, the others are rows with a fault. Null identifiers link
    to nothing. Arguments that aren't a JSON object, and results before their call, are faults too; an empty table
    gives no calls. Other columns of the inputs aren't read.
    """
    key = ["conv_id", "call_id"]
    parsed = settled(
        calls.select("conv_id", "turn", "call_id", "name", "arguments", "needs"), {"v": F.try_parse_json("arguments")}
    ).withColumn("v", F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")))
    parsed = settled(parsed, {"canonical": F.to_json("v")}).drop("arguments")
    repeats = calls.where("call_id is not null").groupBy(*key).agg(F.count("*").alias("times"))
    answers = results.where("call_id is not null").groupBy(*key).agg(
        F.min(F.struct("turn", F.col("content"))).alias("answer")
    )
    placed = order_calls(calls).withColumnRenamed("level", "at")
    facts = placed.join(repeats, [placed[k].eqNullSafe(repeats[k]) for k in key]).select(*[placed[k] for k in key], "at", "times")
    facts = facts.select(F.col("conv_id").alias("c1"), F.col("call_id").alias("n1"), F.col("at").alias("level"), "times")
    answers = answers.select(F.col("conv_id").alias("c2"), F.col("call_id").alias("n2"), "answer")
    met = (
        parsed.hint("shuffle_hash").join(facts, F.col("conv_id").eqNullSafe(F.col("c1")) & (F.col("call_id") == F.col("n1")), "left")
        .join(answers.hint("shuffle_hash"), F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("call_id") == F.col("n2")), "left")
    )
    faults = F.concat(
        schema_faults(F.col("name"), F.col("v"), F.col("canonical"), schemas),
        F.array_compact(F.array(
            F.when(F.col("call_id").isNull(), F.lit("no identifier")), F.when(F.col("times") > 1, F.lit("repeated identifier")),
            F.when(F.col("call_id").isNotNull() & F.col("level").isNull(), F.lit("ring of needs")),
            F.when(F.col("answer")["turn"] < F.col("turn"), F.lit("result before its call")),
        )),
    )
    # Keys in alphabetical order; null values are left out.
    line = F.concat(
        F.lit('{"arguments":'), F.coalesce("canonical", F.lit("null")),
        F.when(F.col("call_id").isNotNull(), F.concat(F.lit(',"id":'), _quoted("call_id"))).otherwise(""),
        F.when(F.col("name").isNotNull(), F.concat(F.lit(',"name":'), _quoted("name"))).otherwise(""),
        F.when(F.col("answer")["content"].isNotNull(), F.concat(F.lit(',"result":'), _quoted(F.col("answer")["content"]))).otherwise(""),
        F.lit(',"type":"function"}'),
    )
    linked = met.select(
        "conv_id", "turn", "call_id", "level", F.col("answer")["turn"].alias("result_turn"),
        F.when(F.col("answer").isNull(), "unanswered").otherwise("linked").alias("status"),
        (F.size(faults) == 0).alias("valid"), faults.alias("faults"), line.alias("json"),
    )
    asked = calls.where("call_id is not null").select(F.col("conv_id").alias("c"), F.col("call_id").alias("n")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("n"))
    lone = results.join(asked, same, "left_anti").select("conv_id", "turn", "call_id", "content")
    # All but one row of what an identifier got; equal results are counted, not compared.
    got = results.join(asked, same, "left_semi").groupBy(*key, "turn", "content").agg(F.count("*").alias("times"))
    got = got.join(answers, F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("call_id") == F.col("n2")))
    is_first = F.struct("turn", "content").eqNullSafe(F.col("answer"))
    further = got.withColumn("times", F.col("times") - is_first.cast("int")).where("times > 0")
    further = further.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).select(*lone.columns)

    def unlinked(rows: DataFrame, status: str, fault: str) -> DataFrame:
        return rows.select(
            "conv_id", F.lit(None).cast(calls.schema["turn"].dataType).alias("turn"), "call_id", F.lit(None).cast("int").alias("level"),
            F.col("turn").alias("result_turn"), F.lit(status).alias("status"), F.lit(False).alias("valid"), F.array(F.lit(fault)).alias("faults"),
            F.concat(
                F.when(F.col("call_id").isNotNull(), F.concat(F.lit('{"id":'), _quoted("call_id"), F.lit(","))).otherwise("{"),
                F.when(F.col("content").isNotNull(), F.concat(F.lit('"result":'), _quoted("content"), F.lit(","))).otherwise(""),
                F.lit('"type":"result"}'),
            ).alias("json"),
        )

    return linked.unionByName(unlinked(lone, "orphan", "no such call")).unionByName(unlinked(further, "repeated", "repeated result"))


def _quoted(text: Column | str) -> Column:
    """A JSON string."""
    whole = F.to_json(F.array(F.col(text) if isinstance(text, str) else text))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def calls_of_turns(conversations: DataFrame) -> DataFrame:
    """Assistant turns as calls of a tool ``reply``; each needs the assistant's turn before it."""
    text = whole_text()
    call = F.concat_ws("-", F.lit("call"), "conv_id", "turn")
    before = F.concat_ws("-", F.lit("call"), "conv_id", F.col("turn") - 2)
    arguments = F.concat(
        F.lit('{ "words": '), F.regexp_count(text, F.lit(WORD)), F.lit(', "first": '), _quoted(F.regexp_extract(text, WORD, 0)),
        F.lit(',\n"chars":'), F.length(text), F.lit(" }"),
    )
    return conversations.where("role = 'assistant'").select(
        "conv_id", "turn", call.alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"),
        F.array(before).alias("needs"),
    )


def results_of_turns(conversations: DataFrame) -> DataFrame:
    """User turns as results of what stands one turn before."""
    before = F.concat_ws("-", F.lit("call"), "conv_id", F.col("turn") - 1)
    return conversations.where("role = 'user'").select("conv_id", "turn", before.alias("call_id"), F.col("text").alias("content"))


REPLY = {"reply": [Parameter("words", "integer", least=5, most=200), Parameter("first", "string"), Parameter("chars", "integer", most=1200)]}

SQL = r"""
with t as (select conv_id, turn, role, coalesce(text, '') as t, text,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words,
    regexp_extract(coalesce(text, ''), '[^\x20\x09-\x0D]+') as first from conversations),
c as (select *, 'call-' || conv_id || '-' || turn as call_id from t where role = 'assistant'),
lv as (select a.conv_id, a.turn, (select count(*) from c b where b.conv_id = a.conv_id and b.turn < a.turn
    and (a.turn - b.turn) % 2 = 0 and b.turn > coalesce((select max(g) from (select x.turn + 2 as g from c x where x.conv_id = a.conv_id
        and not exists (select 1 from c y where y.conv_id = x.conv_id and y.turn = x.turn + 2)) where g < a.turn and (a.turn - g) % 2 = 0), -1))::int as level
    from c a)
select c.conv_id, c.turn, c.call_id, lv.level, r.turn as result_turn,
    case when r.turn is null then 'unanswered' else 'linked' end as status,
    c.words between 5 and 200 and length(c.t) <= 1200 as valid,
    concat_ws('; ', case when c.words < 5 then 'words: too small' end, case when c.words > 200 then 'words: too large' end,
        case when length(c.t) > 1200 then 'chars: too large' end) as faults,
    '{"arguments":{"chars":' || length(c.t) || ',"first":' || to_json(c.first) || ',"words":' || c.words || '},"id":"'
        || c.call_id || '","name":"reply"' || case when r.text is null then '' else ',"result":' || to_json(r.text) end
        || ',"type":"function"}' as json
from c join lv using (conv_id, turn) left join t r on r.conv_id = c.conv_id and r.turn = c.turn + 1 and r.role = 'user'
union all
select r.conv_id, null, 'call-' || r.conv_id || '-' || (r.turn - 1), null, r.turn, 'orphan', false, 'no such call',
    '{"id":"call-' || r.conv_id || '-' || (r.turn - 1) || '",' || case when r.text is null then '' else '"result":' || to_json(r.text) || ',' end
        || '"type":"result"}'
from t r where role = 'user' and not exists (select 1 from c where c.conv_id = r.conv_id and c.turn = r.turn - 1)
"""


@query("op2_tool_links", SQL)
def op2_tool_links(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    found = link_tool_calls(calls_of_turns(turns), results_of_turns(turns), REPLY)
    return found.withColumn("faults", F.array_join("faults", "; "))
