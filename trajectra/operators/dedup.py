"""Deduplication of logged requests within an instance: failed, prefix, short and exact."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys that differ between copies of a request.
_DROPPED_KEYS = frozenset(("cache_control", "signature", "generation"))
_CCH = re.compile(r"cch=[0-9a-fA-F]+;")


def not_failed(raw: Column) -> Column:
    """Whether a logged record's success isn't literally false (null, missing, "false" and 0 are kept)."""
    found = F.get_json_object(raw, "$.success")
    literal = F.schema_of_variant(F.variant_get(F.try_parse_json(raw), "$.success", "variant")) == "BOOLEAN"
    return ~(F.coalesce(literal, F.lit(False)) & F.coalesce(found == "false", F.lit(False)))


def _strip(value):
    if isinstance(value, dict):
        return {k: ([_strip(x) for x in v if not (isinstance(x, dict) and x.get("type") == "thinking")] if k == "content" and isinstance(v, list) else _strip(v)) for k, v in value.items() if k not in _DROPPED_KEYS}
    return [_strip(v) for v in value] if isinstance(value, list) else value


def _chosen_input(item: dict):
    """What a request was asked: its input, else a nested one, else its messages."""
    body = item.get("request_body") or {}
    if "input" in body:
        return body["input"]
    nested = (body.get("extra_params") or {}).get("input") if isinstance(body.get("extra_params"), dict) else None
    return nested or body.get("messages") or ""


def normal_form(raw: str) -> tuple[str | None, int | None, str | None]:
    """Comparable input, its number of items (0 for other shapes) and comparable record; nulls for text that is no JSON object."""
    try:
        item = json.loads(raw)
    except (ValueError, TypeError):
        return None, None, None
    if not isinstance(item, dict):
        return None, None, None
    asked = _chosen_input(item)
    count = len(asked) if isinstance(asked, list) else 0
    if isinstance(asked, str):
        text = asked
    else:
        value = _strip(asked)
        if isinstance(value, list):
            for m in value:
                if isinstance(m, dict) and m.get("role") == "user":
                    if isinstance(m.get("content"), list):
                        m["content"] = "".join(b.get("text", "") for b in m["content"] if isinstance(b, dict))
                    break
        text = json.dumps(value, ensure_ascii=False, sort_keys=True)
        if text[:1] == "[" and text[-1:] == "]":
            text = text[1:-1]
    return _CCH.sub("cch=;", text), count, json.dumps(_strip(item), ensure_ascii=False, sort_keys=True)


def normal_forms(raw: Column) -> Column:
    """struct<input, items, record> of logged JSON lines."""

    @F.arrow_udf("struct<input:string,items:bigint,record:string>")
    def forms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [normal_form(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], ["input", "items", "record"])

    return forms(raw)


def dedup_prefix(rows: DataFrame, instance: str, position: str, text: str) -> DataFrame:
    """Rows whose text isn't the beginning of a later row's text of the same instance (of equal texts the last stays).

    Hashes are joined, texts are not.  A text of n characters can only begin one that shares its first 2**k, the
    greatest power of two in n: so each text asks, for each power of two within it, which lengths such texts have, and
    hashes its own beginnings of these lengths.  The greatest position of each beginning then decides.  Positions are
    unique in an instance; rows with a null instance, position or text stay.
    """
    base = rows.select(F.col(instance).alias("i"), F.col(position).alias("p"), F.col(text).alias("t"))
    name = lambda t: [F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2")]
    log = lambda n: F.floor(F.log2(n)).cast("int")  # noqa: E731  exact for lengths of strings
    start = lambda t, k: F.when(k < 0, F.lit("")).otherwise(F.substring(t, F.lit(1), F.call_function("shiftleft", F.lit(1), F.greatest(k, F.lit(0)))))
    n = F.length("t")
    own = base.select("i", "p", n.alias("n"), *name(F.col("t")))
    k = F.when(n > 0, log(n)).otherwise(-1)
    lengths = base.select("i", k.alias("k"), F.xxhash64(start(F.col("t"), k)).alias("key"), n.alias("n")).distinct()
    begun = F.transform(F.sequence(F.lit(-1), k), lambda j: F.struct(j.alias("k"), F.xxhash64(start(F.col("t"), j)).alias("key")))
    asks = base.filter("t IS NOT NULL").select("i", "p", n.alias("longer"), F.inline(begun))
    wanted = asks.join(lengths, ["i", "k", "key"]).filter("n < longer").groupBy("i", "p").agg(F.collect_set("n").alias("ns"))
    proper = base.join(wanted, ["i", "p"]).select("i", "p", "t", F.explode("ns").alias("n")).select("i", "p", "n", *name(F.substring("t", F.lit(1), F.col("n"))))
    last = own.select("i", "p", "n", "h1", "h2").unionByName(proper).groupBy("i", "n", "h1", "h2").agg(F.max("p").alias("last"))
    dropped = own.join(last, ["i", "n", "h1", "h2"]).filter("p < last").select(F.col("i").alias(instance), F.col("p").alias(position))
    return rows.join(dropped, [instance, position], "left_anti")


def dedup_exact(rows: DataFrame, instance: str, position: str, key: str) -> DataFrame:
    """The first row of each instance and key."""
    first = rows.groupBy(instance, F.sha2(key, 256).alias("__k")).agg(F.min(position).alias(position)).drop("__k")
    return rows.join(first, [instance, position], "left_semi")


def drop_short(rows: DataFrame, items: str, more_than: int = 2) -> DataFrame:
    return rows.filter(F.coalesce(items, F.lit(0)) > more_than)


def dedup_requests(logged: DataFrame) -> DataFrame:
    """All steps over (instance_id, line_no, raw): failed out, ordered by request time, prefixes, short and equal ones out.

    Lines that are no JSON object are left out.  pos is the row's place in its instance.
    """
    time = F.coalesce(F.get_json_object("raw", "$.request_time").try_cast("double"), F.lit(0.0))
    good = logged.filter(not_failed(F.col("raw"))).withColumn("f", normal_forms(F.col("raw"))).filter("f.record IS NOT NULL")
    order = Window.partitionBy("instance_id").orderBy(time, "line_no")
    placed = good.withColumn("pos", F.row_number().over(order)).select("instance_id", "line_no", "raw", "pos", F.col("f.input").alias("input"), F.col("f.items").alias("items"), F.col("f.record").alias("record"))
    left = drop_short(dedup_prefix(placed, "instance_id", "pos", "input"), "items").filter("instance_id IS NOT NULL")
    # as dedup_exact(), which reads its rows twice: all above would be made twice, the parsing in Python too
    equal = Window.partitionBy("instance_id", F.sha2("record", 256)).orderBy("pos")
    return left.withColumn("nth", F.row_number().over(equal)).filter("nth = 1").select("instance_id", "line_no", "pos", "raw")
