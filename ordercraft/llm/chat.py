"""Chat formatting: tool calls linked to their results.

Calls and results are joined by identifier inside a conversation, calls are ordered topologically by the results
their arguments refer to, arguments are validated against the tools' schemas, and every message is serialised as
canonical JSON (sorted keys, no blanks, normalised numbers). DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ordercraft.session import materialize

# A string argument "${id}" anywhere in the arguments refers to the result of call ``id``.
REFERENCE = r"\$\{([^}]*)\}"

# Variant type names of each JSON schema type.
_TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"],
          "array": ["ARRAY"], "object": ["OBJECT"]}


def _type(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)


def argument_errors(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """Errors of a variant of arguments under the tool's schema, in field order (none: an empty array).

    A schema has ``properties`` (name to ``type``, and optional ``minimum``, ``maximum``, ``enum``, ``maxLength``),
    ``required`` and ``additionalProperties``.
    """
    def number(value: Column) -> Column:
        return F.try_variant_get(value, "$", "double")

    def of(schema: dict) -> Column:
        found = []
        for field, rule in sorted(schema["properties"].items()):
            value = F.try_variant_get(arguments, f"$['{field}']", "variant")
            kind = _type(value)
            missing = value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(False))
            if field in schema.get("required", ()):
                found.append(F.when(missing, F.lit(f"{field}: missing")))
            checks = [(~kind.isin(_TYPES[rule["type"]]), f"not {rule['type']}")]
            if "minimum" in rule:
                checks.append((number(value) < rule["minimum"], f"below {rule['minimum']}"))
            if "maximum" in rule:
                checks.append((number(value) > rule["maximum"], f"above {rule['maximum']}"))
            text = F.try_variant_get(value, "$", "string")
            if "enum" in rule:
                checks.append((~text.isin(rule["enum"]), "not allowed"))
            if "maxLength" in rule:
                checks.append((F.char_length(text) > rule["maxLength"], "too long"))
            found += [F.when(~missing & wrong, F.lit(f"{field}: {what}")) for wrong, what in checks]
        if schema.get("additionalProperties") is False:
            keys = F.map_keys(F.try_variant_get(arguments, "$", "map<string,variant>"))
            extra = F.array_except(keys, F.array(*[F.lit(f) for f in schema["properties"]]).cast("array<string>"))
            found.append(F.when(F.size(extra) > 0, F.concat(F.lit("unknown: "), F.array_join(F.array_sort(extra), ","))))
        return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")

    one = lambda text: F.array(F.lit(text))
    errors = F.when(arguments.isNull() | (_type(arguments) != "OBJECT"), one("arguments: not a JSON object"))
    for tool, schema in sorted(schemas.items()):
        errors = errors.when(name == tool, of(schema))
    return errors.otherwise(one("unknown tool"))


def topological_depth(edges: DataFrame) -> DataFrame:
    """``(conv_id, call_id, depth)`` of the calls that others must precede.

    ``edges(conv_id, call_id, needs)``, distinct, without NULLs. Depth is 1 plus the largest depth of the calls needed (0 if
    they need none); a call on or behind a cycle has depth NULL. Chains of calls that need one call each take log2 of their
    length in rounds (see ``_chains``); calls that need several are then ordered level by level, with the chains between
    them as single steps, so these take as many rounds as the most of them on one path.
    """
    key = ["conv_id", "call_id"]
    edges = materialize(edges, "chat-edges")
    counted = materialize(edges.groupBy(*key).agg(F.count("*").alias("n"), F.min("needs").alias("to")), "chat-counted")
    chains = _chains(counted.where("n = 1").select(*key, "to"))
    several = counted.where("n > 1").select(*key)
    if several.isEmpty():
        return chains.select(*key, F.when(~F.col("open"), F.col("steps")).cast("int").alias("depth"))

    at_end = F.when(F.col("open"), F.lit(None)).otherwise(F.col("to"))  # NULL: into a cycle of calls that need one call each
    ends = chains.select("conv_id", F.col("call_id").alias("needs"), at_end.alias("to"), "steps", F.lit(True).alias("chain"))
    left = edges.join(several, key, "left_semi").join(ends, ["conv_id", "needs"], "left").select(
        *key, F.when(F.col("chain"), F.col("to")).otherwise(F.col("needs")).alias("to"), (1 + F.coalesce("steps", F.lit(0))).alias("steps"))
    left = left.groupBy(*key, "to").agg(F.max("steps").alias("steps"))
    last = several.select("conv_id", F.col("call_id").alias("to"), F.lit(True).alias("waits"))
    left = materialize(left.join(last, ["conv_id", "to"], "left").withColumn(
        "value", F.when(F.col("to").isNotNull() & F.col("waits").isNull(), F.col("steps"))).drop("waits"), "chat-left")
    levels = left.select(*key, F.col("steps").alias("depth")).limit(0)
    while True:
        ready = materialize(left.groupBy(*key).agg(
            F.count("*").alias("n"), F.count("value").alias("known"), F.max("value").alias("depth")).where(
            "n = known").select(*key, "depth"), "chat-ready")
        if ready.isEmpty():
            break
        levels = levels.union(ready)
        found = ready.select("conv_id", F.col("call_id").alias("to"), "depth")
        left = materialize(left.join(ready, key, "left_anti").join(found, ["conv_id", "to"], "left").withColumn(
            "value", F.coalesce("value", F.col("depth") + F.col("steps"))).drop("depth"), "chat-left")
    levels = materialize(several.join(levels, key, "left"), "chat-levels")
    last = levels.select("conv_id", F.col("call_id").alias("to"), F.col("depth").alias("last"), F.lit(True).alias("waits"))
    chains = chains.join(last, ["conv_id", "to"], "left").select(
        *key, F.when(~F.col("open"), F.when(F.col("waits"), F.col("last")).otherwise(F.lit(0)) + F.col("steps")).alias("depth"))
    return chains.union(levels).withColumn("depth", F.col("depth").cast("int"))


def _chains(links: DataFrame) -> DataFrame:
    """``conv_id, call_id, to, steps, open`` of the calls ``(conv_id, call_id, to)`` that need one call each.

    ``to`` becomes the first call on the way that is not in ``links``, ``steps`` away; open calls lead into a cycle. A round
    doubles the steps of all open calls, so chains of n calls take log2(n) rounds. As long as one leads out of ``links``, a
    round closes some; when it closes none, those left lead into cycles.
    """
    state = materialize(links.withColumn("steps", F.lit(1).cast("long")).withColumn("open", F.lit(True)), "chat-chains")
    n_open, before = state.count(), None
    while n_open and n_open != before:
        far = state.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("far"), F.col("steps").alias("more"))
        moved = state.where("open").join(far, ["conv_id", "to"], "left").select(
            "conv_id", "call_id", F.coalesce("far", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("far").isNotNull().alias("open"))
        state = materialize(moved.union(state.where("not open").select(*moved.columns)), "chat-chains")
        n_open, before = state.where("open").count(), n_open
    return state


def link_tools(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """A row per message, call and result: ``conv_id, turn, kind, call_id, depth, status, errors, json``.

    ``messages(conv_id, turn, role, text)``, ``calls(conv_id, turn, call_id, name, arguments)``,
    ``results(conv_id, turn, call_id, content)``. In a conversation, rows by (depth, turn, kind) are in an order in which
    every result follows its call and every call the results it refers to (see ``topological_depth``; a result has its
    call's depth, messages keep their turn and have depth 0).

    ``status`` of a call: ``no_id``, ``duplicate_id`` (several calls share the id), ``cycle`` (depth NULL), ``bad_reference`` (refers
    to an id that no single call has), ``invalid`` (see errors), ``no_result``, ``duplicate_result``, else ``ok``. Of a result:
    ``no_id``, ``orphan`` (no call), ``duplicate_id``, ``early`` (not after its call's turn), ``duplicate_result``, else ``ok``.
    NULL conv_ids form one conversation in which nothing is linked. NULL texts are JSON null. Repeated rows stay and
    count as duplicates.
    """
    key = ["conv_id", "call_id"]
    by_call = calls.groupBy(*key).agg(F.count("*").alias("n_calls"), F.min("turn").alias("call_turn"))
    by_result = results.groupBy(*key).agg(F.count("*").alias("n_results"))
    parsed = materialize(calls.withColumn("args", F.try_parse_json("arguments")).withColumn(
        "errors", argument_errors(F.col("name"), F.col("args"), schemas)).withColumn(
        "needs", F.array_distinct(F.regexp_extract_all("arguments", F.lit(REFERENCE)))), "chat-calls")
    refers = parsed.where("conv_id is not null and call_id is not null").select(
        "conv_id", "call_id", F.explode("needs").alias("needs")).distinct()
    known = by_call.select("conv_id", F.col("call_id").alias("needs"), "n_calls")
    refers = materialize(refers.join(known, ["conv_id", "needs"], "left"), "chat-refers")
    bad = refers.where(F.coalesce("n_calls", F.lit(0)) != 1).select(*key).distinct().withColumn("bad", F.lit(True))
    depth = topological_depth(refers.where("n_calls = 1").select(*key, "needs")).withColumn("ordered", F.lit(True))

    linked = parsed.join(by_call, key, "left").join(by_result, key, "left").join(bad, key, "left").join(depth, key, "left")
    in_order = F.when(F.col("ordered"), F.col("depth")).otherwise(F.lit(0))
    call_rows = linked.select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id", in_order.alias("depth"),
        F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), "no_id")
        .when(F.col("n_calls") > 1, "duplicate_id").when(in_order.isNull(), "cycle").when(F.col("bad"), "bad_reference")
        .when(F.size("errors") > 0, "invalid").when(F.col("n_results").isNull(), "no_result")
        .when(F.col("n_results") > 1, "duplicate_result").otherwise("ok").alias("status"),
        "errors",
        _json(F.struct(F.col("args").alias("arguments"),
                       F.col("call_id").alias("id"), "name", F.lit("assistant").alias("role"))).alias("json"))
    result_rows = results.join(by_call, key, "left").join(by_result, key, "left").join(depth, key, "left").select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", in_order.alias("depth"),
        F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), "no_id")
        .when(F.col("n_calls").isNull(), "orphan").when(F.col("n_calls") > 1, "duplicate_id")
        .when(F.col("turn") <= F.col("call_turn"), "early").when(F.col("n_results") > 1, "duplicate_result")
        .otherwise("ok").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        _json(F.struct("content", F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id"))).alias("json"))
    message_rows = messages.select(
        "conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.lit(0).alias("depth"),
        F.lit("ok").alias("status"), F.array().cast("array<string>").alias("errors"),
        _json(F.struct(F.col("text").alias("content"), "role")).alias("json"))
    return message_rows.union(call_rows).union(result_rows)


def _json(fields: Column) -> Column:
    """Canonical JSON of a struct whose fields are already in key order; variants are in key order by themselves."""
    return F.to_json(fields, {"ignoreNullFields": "false"})


# The tools of the registered query.
SCHEMAS = {
    "search": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 100},
                              "source": {"type": "string"}},
               "required": ["query", "limit"], "additionalProperties": False},
    "rank": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 200},
                            "source": {"type": "string"}},
             "required": ["query", "source"], "additionalProperties": False},
}


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the table's turns stand for.

    Every assistant turn is a call with its text as query and its word count as limit; from the second pair of turns on
    it refers to the call two turns before. Every user turn from turn 1 on is the result of the turn before it.
    """
    text, turn = F.col("text"), F.col("turn")
    ident = lambda t: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), t.cast("string"))
    words = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    source = F.when(turn >= 3, F.concat(F.lit(', "source" : "${'), ident(turn - 2), F.lit('}"'))).otherwise(F.lit(""))
    content = F.substring(F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("t"))), 6, 2147483647)  # quoted text and }
    calls = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", ident(turn).alias("call_id"), F.when(turn % 2 == 0, "search").otherwise("rank").alias("name"),
        F.concat(F.lit('{ "limit" : '), words.cast("string"), source, F.lit(', "query":'), content).alias("arguments"))
    results = conversations.where("role = 'user' and turn >= 1").select(
        "conv_id", "turn", ident(turn - 1).alias("call_id"), text.alias("content"))
    return calls, results


def op10_chat_format(spark, sf_dir: str) -> DataFrame:
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    calls, results = calls_of(talk)
    return link_tools(talk, calls, results, SCHEMAS).withColumn("errors", F.array_join("errors", "; "))


ORACLE = r"""
with t as (
  select *, 'c' || conv_id || '-' || turn me, 'c' || conv_id || '-' || (turn - 1) before, 'c' || conv_id || '-' || (turn - 2) two_before,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) words
  from conversations),
c as (
  select conv_id, turn, me id, words, two_before source, coalesce(text, '') q, turn % 2 = 0 is_search, turn >= 3 has_source
  from t where role = 'assistant'),
n_call as (select conv_id, id, count(*) n, min(turn) call_turn from c group by all),
r as (select conv_id, turn, before id, text from t where role = 'user' and turn >= 1),
n_result as (select conv_id, id, count(*) n from r group by all),
e as (select c.conv_id, c.id, s.n n_source, c.source from (select distinct conv_id, id, source from c where has_source) c
      left join n_call s on s.conv_id = c.conv_id and s.id = c.source),
depth as (
  with recursive d(conv_id, id, depth) as (
    select conv_id, id, 0 from n_call where (conv_id, id) not in (select (conv_id, id) from e where n_source = 1)
    union all
    select e.conv_id, e.id, d.depth + 1 from d join e on e.conv_id = d.conv_id and e.source = d.id and e.n_source = 1)
  select conv_id, id, max(depth) depth from d group by all),
call_error as (
  select c.*, list_filter([
    case when words < 1 then 'limit: below 1' end,
    case when words > case when is_search then 100 else 200 end then 'limit: above ' || case when is_search then '100' else '200' end end,
    case when not is_search and not has_source then 'source: missing' end], lambda x: x is not null) errors
  from c)
select conv_id, turn, 'message' kind, null::varchar call_id, 0 as depth, 'ok' status, '' errors,
       '{"content":' || coalesce(to_json(text)::varchar, 'null') || ',"role":' || coalesce(to_json(role)::varchar, 'null') || '}' json
from t
union all
select c.conv_id, c.turn, 'call', c.id, d.depth,
       case when nc.n > 1 then 'duplicate_id' when has_source and coalesce(e.n_source, 0) <> 1 then 'bad_reference'
            when len(errors) > 0 then 'invalid' when nr.n is null then 'no_result' when nr.n > 1 then 'duplicate_result' else 'ok' end,
       array_to_string(errors, '; '),
       '{"arguments":{"limit":' || words || ',"query":' || to_json(q)::varchar
         || case when has_source then ',"source":"${' || c.source || '}"' else '' end
         || '},"id":"' || c.id || '","name":"' || case when is_search then 'search' else 'rank' end || '","role":"assistant"}'
from call_error c join n_call nc using (conv_id, id) left join n_result nr using (conv_id, id)
left join depth d using (conv_id, id) left join e using (conv_id, id)
union all
select r.conv_id, r.turn, 'result', r.id, coalesce(d.depth, 0),
       case when nc.n is null then 'orphan' when nc.n > 1 then 'duplicate_id' when r.turn <= nc.call_turn then 'early'
            when nr.n > 1 then 'duplicate_result' else 'ok' end, '',
       '{"content":' || coalesce(to_json(r.text)::varchar, 'null') || ',"role":"tool","tool_call_id":"' || r.id || '"}'
from r left join n_call nc using (conv_id, id) left join n_result nr using (conv_id, id) left join depth d using (conv_id, id)
"""
