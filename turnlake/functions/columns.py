"""Column expressions for wire values. Null stands for an absent value everywhere."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUL = "\x00"
MARK = "[encrypted]"


def present(c: Column) -> Column:
    """The text, or null when empty."""
    return F.nullif(c, F.lit(""))


def first_present(*cs: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[present(c) for c in cs])


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; of two that differ in case only, the later wins."""
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(F.map_keys(headers), F.lower)
    last = F.filter(pairs, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), e["key"]))
    # hardly any headers have two such names, and comparing all of them costs more than the rest of a frame's decoding
    return F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_arrays(names, F.map_values(headers))).when(headers.isNotNull(), F.map_from_entries(last))


def payload_text(text: Column, error: Column) -> Column:
    """A frame's event text from variants: a string as it is, an object as JSON, an error alone as an error event."""
    kind = F.schema_of_variant(text)
    return (
        F.when(kind == "STRING", F.try_variant_get(text, "$", "string"))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(text))
        .when(F.schema_of_variant(error) != "VOID", F.concat(F.lit('{"type":"error","error":'), F.to_json(error), F.lit("}")))
    )


def sse_data(text: Column) -> Column:
    """The data lines of the first server-sent event that has any, joined; byte-order mark, CR and comments are dropped."""
    clean = F.regexp_replace(F.regexp_replace(text, "^﻿", ""), "\r\n?", "\n")
    blocks = F.transform(F.split(clean, "\n\n+"), lambda b: F.filter(F.split(b, "\n"), lambda x: x.startswith("data:")))
    first = F.try_element_at(F.filter(blocks, lambda b: F.size(b) > 0), F.lit(1))
    return F.array_join(F.transform(first, lambda x: F.regexp_replace(x, "^data: ?", "")), "\n")


def event(text: Column) -> Column:
    """The event as a variant: JSON, or the JSON in a server-sent event."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(sse_data(text)))


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys and no blanks; null when it isn't JSON."""
    return F.to_json(F.try_parse_json(text))


def flat_text(v: Column) -> Column:
    """A message's text from a variant: a string, or the texts of its parts one after the other, or nothing."""
    kind = F.schema_of_variant(v)
    parts = F.try_variant_get(v, "$", "array<variant>")
    texts = F.transform(parts, lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.lit("")))
    return F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind.startswith("ARRAY"), F.array_join(texts, "")).otherwise("")


def short_hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def whole_characters(raw: Column) -> Column:
    """Text from the start of some text's UTF-8 bytes: of what a cut can leave, only the start of a character may stand at the end, and goes."""
    tail = F.hex(F.substring(raw, -3, 3))
    cut = (
        F.when(F.regexp_like(tail, F.lit("(C[2-9A-F]|D.|E.|F[0-4])$")), F.lit(1))
        .when(F.regexp_like(tail, F.lit("(E.|F[0-4])[89AB].$")), F.lit(2))
        .when(F.regexp_like(tail, F.lit("^F[0-4][89AB].[89AB].$")), F.lit(3))
        .otherwise(F.lit(0))
    )
    return F.decode(F.substring(raw, F.lit(1), F.octet_length(raw) - cut), "UTF-8")


def byte_cut(c: Column, most: int) -> Column:
    """At most so many bytes of UTF-8, never part of a character."""
    return F.when(F.octet_length(c) <= most, c).otherwise(whole_characters(F.substring(F.encode(c, "UTF-8"), 1, most)))


def duration_seconds(c: Column) -> Column:
    """Seconds of "1h30m", "45s", "250ms" or a plain number; null unless positive."""
    unit = {"h": 3600.0, "m": 60.0, "s": 1.0, "ms": 0.001, "us": 1e-6, "ns": 1e-9}
    total = F.lit(0.0)
    for name, seconds in unit.items():
        found = F.regexp_extract_all(c, F.lit(rf"([0-9]+(?:\.[0-9]+)?){name}(?![a-z])"), F.lit(1))
        total = total + F.aggregate(found, F.lit(0.0), lambda a, x: a + x.cast("double")) * seconds
    whole = F.regexp_like(c, F.lit(r"^([0-9]+(\.[0-9]+)?(ns|us|ms|s|m|h))+$"))
    out = F.when(whole, total).otherwise(c.try_cast("double"))
    return F.when(out > 0, out)


def epoch_time(seconds: Column) -> Column:
    """A time from fractional epoch seconds, cut to milliseconds; null unless positive."""
    return F.when(seconds > 0, F.timestamp_millis(F.floor(seconds * 1000)))


def balance(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "[$,]", "").try_cast("double")


def family(originator: Column, request_id: Column, probes: Iterable[str] = ("probe",)) -> Column:
    return (
        F.when(originator.isin(*probes), "probe")
        .when(F.coalesce(request_id, F.lit("")) == "", "unknown")
        .when(request_id.startswith("ws_"), "websocket")
        .otherwise("http")
    )


def id_shape(c: Column) -> Column:
    uuid = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
    return (
        F.when(F.coalesce(c, F.lit("")) == "", "empty")
        .when(c.startswith("ws_"), "ws_")
        .when(c.startswith("resp_"), "resp_")
        .when(F.regexp_like(c, F.lit(uuid)), "uuid")
        .otherwise(F.concat(F.lit("other:len"), F.octet_length(c).cast("string")))
    )


def framing(c: Column) -> Column:
    t = F.trim(c)
    return (
        F.when(F.coalesce(t, F.lit("")) == "", "empty")
        .when(F.regexp_like(t, F.lit("^(data|event|id|retry|):")), "sse")
        .when(t.startswith("{"), "object")
        .when(t.startswith("["), "array")
        .when(F.try_parse_json(t).isNotNull(), "scalar")
        .otherwise("plain")
    )


def digit_mask(c: Column) -> Column:
    return F.regexp_replace(c, "[0-9]+", "N")


def magnitude(n: Column) -> Column:
    return F.when(n > 0, F.length(n.cast("long").cast("string")) - 1).otherwise(-1).cast("int")


def one_line(c: Column, most: int) -> Column:
    t = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 1), F.lit("…"))).otherwise(t)


def head_tail(c: Column, head: int, tail: int) -> Column:
    n = F.length(c)
    cut = F.concat(F.substring(c, 1, head), F.lit("…["), (n - head - tail).cast("string"), F.lit(" chars elided]…"), F.right(c, F.lit(tail)))
    return F.when(n > head + tail, cut).otherwise(c)


def bare_account(c: Column) -> Column:
    return F.substring_index(c, "_", 1)


def routing_hint(hint: Column, model: Column) -> Column:
    value = F.regexp_extract(F.coalesce(hint, F.lit("")), "model=([^;,\\s]+)", 1)
    return F.when(value == "", "absent").when(value == model, "agree").otherwise("disagree")


def bounded(c: Column, known: Iterable[str]) -> Column:
    return F.when(c.isin(*known), c).otherwise("unknown")


#: Unpadded base64 of 73 bytes or more, the first of which is 0x80.
_SECRET = re.compile(r"g[A-P][A-Za-z0-9_-]{96,}")


def _encrypted(text: str) -> bool:
    found = text.rstrip("=").replace("\r", "").replace("\n", "")
    return len(found) % 4 != 1 and _SECRET.fullmatch(found) is not None


def _redacted(value, under: bool) -> tuple[object, int]:
    if isinstance(value, dict):
        pairs = [(k, *_redacted(v, under or "encrypted" in k.lower())) for k, v in value.items()]
        return {k: v for k, v, _ in pairs}, sum(n for _, _, n in pairs)
    if isinstance(value, list):
        items = [_redacted(v, under) for v in value]
        return [v for v, _ in items], sum(n for _, n in items)
    if isinstance(value, str) and (under or _encrypted(value)):
        return MARK, 1
    return value, 0


@F.pandas_udf(T.StructType([T.StructField("body", T.StringType()), T.StructField("hidden", T.IntegerType())]))
def redact_arguments(arguments: pd.Series) -> pd.DataFrame:
    """Tool arguments with encrypted values replaced, however deep; null and text that isn't JSON stay. Needs recursion, so it runs in Python."""
    out = []
    for a in arguments:
        try:
            value, n = _redacted(json.loads(a), False)
            out.append((json.dumps(value, separators=(",", ":"), ensure_ascii=False) if n else a, n))
        except (TypeError, ValueError):
            out.append((a, 0))
    return pd.DataFrame(out, columns=["body", "hidden"])


def hidden_arguments(arguments: Column) -> Column:
    """``(body, hidden)`` of :func:`redact_arguments`, and text that isn't JSON as a JSON string; only text that may hold something encrypted
    goes to Python: a name with the word, or letters that such a value begins with, which escapes may hide."""
    suspect = F.lower(arguments).contains("encrypted") | ((F.length(arguments) >= 98) & F.regexp_like(arguments, F.lit(r"g[A-P]|\\u00")))
    suspect = suspect & F.try_parse_json(arguments).isNotNull()
    quoted = F.regexp_replace(F.to_json(F.array(arguments)), r"^\[|\]$", "")
    body = F.when(F.try_parse_json(arguments).isNull() & arguments.isNotNull(), quoted).otherwise(arguments)
    plain = F.struct(body.alias("body"), F.lit(0).cast("int").alias("hidden"))
    return F.when(suspect, redact_arguments(F.when(suspect, arguments))).otherwise(plain)


def bound_json(c: Column, most: int) -> Column:
    """JSON within a byte budget; what is over it becomes the smallest valid value that says so."""
    small = F.lit('{"truncated":true}')
    return F.when(F.octet_length(c) <= most, c).otherwise(small if most >= 18 else F.lit("null") if most >= 4 else F.lit("0"))
