"""FN-8, FN-11..FN-19: remaining scalar column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hexcodec import hex_to_long


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_block_label(n, width: int = 8) -> Column:
    """FN-8: zero-padded block label; a longer number is kept whole (``lpad``
    alone would cut it)."""
    s = _col(n).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def strip_leading_zero(c) -> Column:
    """FN-8: '07' -> '7' (text through int)."""
    return _col(c).try_cast("int").cast("string")


def chunk_label(start, end, width: int = 8) -> Column:
    """SNK-4 file label '%08d_%08d'."""
    return F.concat_ws("_", pad_block_label(start, width), pad_block_label(end, width))


def price_krw(usd, fx, digits: int = 4) -> Column:
    """FN-11: multiply the unrounded inputs, then round (D18)."""
    return F.round(_col(usd) * _col(fx), digits)


def price_usd(usd, digits: int = 4) -> Column:
    return F.round(_col(usd), digits)


def to_json_text(c, keep_nulls: bool = True) -> Column:
    """FN-12: serialise to JSON with null fields; Spark keeps non-ASCII
    characters as is."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(_col(c), opts)


def status_flag(c) -> Column:
    """FN-13: '0x1' or '1' -> '1', everything else (incl. null) -> '0'."""
    return F.when(F.trim(_col(c)).isin("0x1", "1"), F.lit("1")).otherwise(F.lit("0"))


LOG_WIRE_DDL = (
    "array<struct<address:string,transactionHash:string,transactionIndex:string,"
    "blockHash:string,blockNumber:string,data:string,logIndex:string,"
    "removed:boolean,topics:array<string>>>"
)


def convert_logs(logs) -> Column:
    """FN-14: per log rename address->contractAddress, decode the three hex
    fields, default removed=false and topics=[] (PRJ-8)."""
    return F.transform(
        _col(logs),
        lambda l: F.struct(
            l["address"].alias("contractAddress"),
            l["transactionHash"].alias("transactionHash"),
            hex_to_long(l["transactionIndex"]).alias("transactionIndex"),
            l["blockHash"].alias("blockHash"),
            hex_to_long(l["blockNumber"]).alias("blockNumber"),
            l["data"].alias("data"),
            hex_to_long(l["logIndex"]).alias("logIndex"),
            F.coalesce(l["removed"], F.lit(False)).alias("removed"),
            F.coalesce(l["topics"], F.array().cast("array<string>")).alias("topics"),
        ),
    )


def empty_array_to_null(c) -> Column:
    """FN-15: size 0 -> null (kept as an option, as in the reference job)."""
    return F.when(F.size(_col(c)) == 0, F.lit(None)).otherwise(_col(c))


def logs_quality(c) -> Column:
    """D14 data-quality flag: null logs (not delivered, e.g. on follow-up
    pages) are not the same as an empty log list."""
    return (F.when(_col(c).isNull(), F.lit("missing"))
            .when(F.size(_col(c)) == 0, F.lit("empty")).otherwise(F.lit("present")))


def default_array(c, element_type: str) -> Column:
    """PRJ-8: missing array -> []."""
    return F.coalesce(_col(c), F.array().cast(f"array<{element_type}>"))


def shard_lane(block, attempt, lanes: int) -> Column:
    """FN-17: (block + attempt) mod lanes."""
    return F.pmod(_col(block) + _col(attempt), F.lit(lanes))


# The entities that occur in cell text (ampersand last).
_ENTITIES = (("&nbsp;", "\u00a0"), ("&#160;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def strip_text(c) -> Column:
    """Leading and trailing white space of any kind, no-break spaces included."""
    return F.regexp_replace(_col(c), r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def strip_tags(c) -> Column:
    """FN-18: cell text = tags removed, entities decoded, then stripped."""
    out = F.regexp_replace(_col(c), r"<[^>]*>", "")
    for entity, text in _ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(text))
    return strip_text(out)


def json_path(c, path: str) -> Column:
    """FN-19: JSON path read ('$.a.b')."""
    return F.get_json_object(_col(c), path)
