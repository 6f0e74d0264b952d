"""Tool calls and their results, linked, ordered, validated and written as canonical JSON.

*Linking* joins calls and results by conversation and call id.  An id that is used again
keeps its least entry, and ``repeats`` says how many more there were, so a hot id is folded
by partial aggregation before it is joined.  A call without a result is ``unanswered``, a
result without a call is an ``orphan``.

*Order.*  A call comes after the calls it names in ``depends_on``; ``level`` is the longest
way back to a call that names none.  Calls with exactly one dependency are chains: their
heads are found by pointer doubling, in the logarithm of the length.  Calls with several are
then settled wave by wave.  Dependencies that name no call of the conversation are ignored;
calls on or behind a cycle have no level and the error ``cycle``.

*Arguments* are parsed as variants: text that is no JSON is an error, as are unknown and
missing fields and wrong types.  Variants keep keys sorted, which makes the serialised form
canonical: no spaces, sorted keys, one spelling of every number.

Everything is DataFrame expressions.  Null texts are JSON nulls; null conversation ids or
turns are spelled ``null`` in call ids.  Empty tables give empty results.  Columns other than
those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.storage import settle

#: Tool -> field -> (type, required).
Schemas = dict[str, dict[str, tuple[str, bool]]]

KEY = ["conv_id", "call_id"]
# JSON types by the names that Spark gives to variants.
_TYPES = {
    "string": "STRING", "integer": r"BIGINT|DECIMAL\(\d+,0\)", "number": r"BIGINT|DECIMAL\(.*\)|DOUBLE|FLOAT",
    "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*",
}


def quoted(text: Column) -> Column:
    """A string as JSON; null as ``null``."""
    inside = F.to_json(F.array(text))
    return F.substring(inside, F.lit(2), F.length(inside) - 2)


def _errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    known = F.array().cast("array<string>")
    out = F.array(F.concat(F.lit("unknown tool "), name))
    for tool, fields in schemas.items():
        checks = []
        for field, (kind, required) in sorted(fields.items()):
            value = F.schema_of_variant(F.variant_get(parsed, f"$.{field}", "variant"))
            missing = F.lit(f"missing {field}") if required else F.lit(None).cast("string")
            checks.append(
                F.when(value.isNull(), missing)
                .when(~value.rlike(f"^({_TYPES[kind]})$"), F.lit(f"{field} is no {kind}"))
            )
        names = F.array(*(F.lit(f) for f in sorted(fields)))
        extra = F.array_sort(F.array_except(F.coalesce(F.json_object_keys(arguments), known), names))
        found = F.concat(F.filter(F.array(*checks), lambda e: e.isNotNull()),
                         F.transform(extra, lambda f: F.concat(F.lit("unknown "), f)))
        out = F.when(name == tool, F.when(is_object, found).otherwise(F.array(F.lit("no JSON object")))).otherwise(out)
    return out


def levels(deps: DataFrame, calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level.  ``deps`` has conv_id, call_id, dep; ``calls`` has every call once.

    A null conversation is one like any other, and its plain joins need a key: conversations are named by text
    that is never null.
    """
    kind = calls.schema["conv_id"].dataType
    named = F.when(F.col("conv_id").isNull(), "null").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    found = _levels(deps.withColumn("conv_id", named), calls.withColumn("conv_id", named))
    return found.withColumn("conv_id", F.when(F.col("conv_id") != "null", F.substring("conv_id", 2, 1 << 30)).cast(kind))


def _levels(deps: DataFrame, calls: DataFrame) -> DataFrame:
    ids = calls.select(*KEY)
    real = deps.select(*KEY, "dep").where("dep is not null").distinct()
    real = real.join(ids.withColumnRenamed("call_id", "dep"), ["conv_id", "dep"], "left_semi")
    real = settle(real.select(*KEY, "dep"), "tool-deps")
    single = real.groupBy(*KEY).agg(F.min("dep").alias("dep"), F.count("*").alias("n"))
    step = ids.join(single, KEY, "left").select(
        *KEY,
        F.when(F.col("n") == 1, F.col("dep")).otherwise(F.col("call_id")).alias("to"),
        (F.coalesce("n", F.lit(0)) == 1).cast("long").alias("dist"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )
    step = settle(step, "tool-chains")
    # Double the reach until every chain ends at a call that has no dependency or several.
    most = max(1, step.count())
    for _ in range(most.bit_length() + 1):
        far = step.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("to2"), F.col("dist").alias("dist2"))
        longer = step.join(far, ["conv_id", "to"]).select(
            *KEY, F.col("to2").alias("to"), (F.col("dist") + F.col("dist2")).alias("dist"), "n"
        )
        before, step = step, settle(longer, "tool-chains")
        if step.agg(F.sum("dist")).first()[0] == before.agg(F.sum("dist")).first()[0]:
            break
    heads = step.where("n <> 1").select(*KEY, "n")
    done = settle(heads.where("n = 0").select(*KEY, F.lit(0).cast("long").alias("level")), "tool-levels")
    waiting = settle(heads.where("n > 1").select(*KEY), "tool-waiting")
    while not waiting.isEmpty():
        need = waiting.join(real, KEY).join(
            step.select("conv_id", F.col("call_id").alias("dep"), "to", "dist"), ["conv_id", "dep"]
        )
        have = done.select("conv_id", F.col("call_id").alias("to"), "level")
        ready = need.join(have, ["conv_id", "to"], "left").groupBy(*KEY).agg(
            F.max(F.col("level") + F.col("dist") + 1).alias("level"), F.count(F.when(F.col("level").isNull(), 1)).alias("open")
        ).where("open = 0").select(*KEY, "level")
        ready = settle(ready, "tool-levels")
        if ready.isEmpty():
            break
        done = settle(done.unionByName(ready), "tool-levels")
        waiting = settle(waiting.join(ready, KEY, "left_anti"), "tool-waiting")
    head = done.select("conv_id", F.col("call_id").alias("to"), "level")
    return step.join(head, ["conv_id", "to"]).select(*KEY, (F.col("level") + F.col("dist")).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """conv_id, call_id, name, level, status, repeats, errors, json.

    ``calls``: conv_id, call_id, name, arguments (JSON text), depends_on (array of ids).
    ``results``: conv_id, call_id, content.  Calls and results without an id are left alone: they link to nothing.
    """
    one = calls.groupBy(*KEY).agg(
        F.min(F.struct("name", "arguments")).alias("call"), F.count("*").alias("n_calls"))
    answer = results.groupBy(*KEY).agg(F.min(F.struct("content")).alias("answer"), F.count("*").alias("n_results"))
    deps = calls.select(*KEY, F.explode("depends_on").alias("dep"))
    level = levels(deps, calls.select(*KEY).distinct())
    a, b, c = one.alias("a"), answer.alias("b"), level.alias("c")
    same = lambda x, y: (
        F.col(f"{x}.conv_id").eqNullSafe(F.col(f"{y}.conv_id")) & F.col(f"{x}.call_id").eqNullSafe(F.col(f"{y}.call_id")))
    both = a.join(b, same("a", "b"), "full").join(c, same("a", "c"), "left")
    called = F.col("n_calls").isNotNull()
    rows = both.select(
        F.when(called, F.col("a.conv_id")).otherwise(F.col("b.conv_id")).alias("conv_id"),
        F.when(called, F.col("a.call_id")).otherwise(F.col("b.call_id")).alias("call_id"),
        F.col("call.name").alias("name"), "level", F.col("call.arguments").alias("arguments"),
        F.col("answer.content").alias("content"),
        F.when(~called, "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("answered").alias("status"),
        (F.coalesce("n_calls", F.lit(1)) + F.coalesce("n_results", F.lit(1)) - 2).cast("long").alias("repeats"),
    )
    bad = F.when(F.col("status") == "orphan", F.array(F.lit("no call"))).otherwise(
        F.concat(_errors(F.col("name"), F.col("arguments"), schemas),
                 F.when(F.col("level").isNull(), F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>"))))
    rows = rows.withColumn("errors", bad)
    spelled = F.concat(
        F.lit('{"arguments":'), F.coalesce(F.to_json(F.try_parse_json("arguments")), F.lit("null")),
        F.lit(',"content":'), quoted(F.col("content")),
        F.lit(',"errors":'), F.to_json("errors"),
        F.lit(',"id":'), quoted(F.col("call_id")),
        F.lit(',"level":'), F.coalesce(F.col("level").cast("string"), F.lit("null")),
        F.lit(',"name":'), quoted(F.col("name")), F.lit("}"),
    )
    return rows.select("conv_id", "call_id", "name", "level", "status", "repeats", F.array_join("errors", ";").alias("errors"),
                       spelled.alias("json"))


SCHEMAS: Schemas = {
    "reply": {"text": ("string", True), "turn": ("integer", True)},
    "instruct": {"text": ("string", True), "turn": ("integer", True)},
}


def call_id(conv: Column, turn: Column) -> Column:
    part = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    return F.concat(F.lit("call_"), F.substring(F.md5(F.concat(part(conv), F.lit(":"), part(turn))), 1, 24))


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations.

    A user turn calls ``reply``, a system turn ``instruct``; an assistant turn is the result of the call one turn before.
    A call depends on those of the two turns before it, if they are calls.
    """
    conv, turn = F.col("conv_id"), F.col("turn")
    calls = turns.where("role in ('user', 'system')").select(
        "conv_id", call_id(conv, turn).alias("call_id"),
        F.when(F.col("role") == "user", "reply").otherwise("instruct").alias("name"),
        F.concat(F.lit('{"turn":'), F.coalesce(turn.cast("string"), F.lit("null")), F.lit(',"text":'), quoted(F.col("text")),
                 F.lit("}")).alias("arguments"),
        F.when(turn.isNull(), F.array().cast("array<string>")).otherwise(
            F.array(call_id(conv, turn - 1), call_id(conv, turn - 2))).alias("depends_on"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", call_id(conv, turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
