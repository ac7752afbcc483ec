"""Column expressions of the edit domain.  All are built in, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags and comments of reverts, address patterns, limits.
REVERT_TAGS = ["mw-revert", "mw-rollback", "mw-undo", "mw-manual-revert"]
REVERT_COMMENT = r"(?i)\brevert(ed)?\b"
UNDONE_REVISION = r"(?i)undid revision (\d+)"
LARGE_JUMP = 100_000
#: Hexadecimal groups with colons, an optional dotted tail and zone; how many groups is checked beside it.
IPV6_CHARACTERS = r"^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*((?<=:)\d{1,3}(\.\d{1,3}){3})?(%[^%]+)?$"


def once(c: Column) -> Column:
    """c, worked out once a row: what a generator yields isn't copied into the filters and columns that use it."""
    return F.explode(F.array(c))


def is_ipv4(text: Column) -> Column:
    """Four numbers up to 255, of one to three digits."""
    small = F.forall(F.split(text, r"\."), lambda part: part.try_cast("int") <= 255)
    return text.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & small


def is_ipv6(text: Column) -> Column:
    """Eight groups of one to four hexadecimal digits, or fewer with one `::`; a dotted IPv4 tail stands for two groups."""
    bare = F.regexp_replace(text, "%.*$", "")
    tail = F.regexp_extract(bare, r"(\d+\.\d+\.\d+\.\d+)$", 1)
    whole = F.when(tail != "", F.regexp_replace(bare, r"\d+\.\d+\.\d+\.\d+$", "0:0")).otherwise(bare)
    groups = F.regexp_count(whole, F.lit(r"[0-9A-Fa-f]{1,4}"))
    shape = whole.rlike(r"^([0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4})*)?(::)?([0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4})*)?$")
    zipped = F.contains(whole, F.lit("::"))
    return text.rlike(IPV6_CHARACTERS) & shape & F.contains(whole, F.lit(":")) & ((tail == "") | is_ipv4(tail)) & F.when(zipped, groups <= 7).otherwise(groups == 8)


def user_type(user: Column, is_bot: Column) -> Column:
    clean = F.trim(user)
    anonymous = user.isNull() | (clean == "") | is_ipv4(clean) | is_ipv6(clean)
    return F.when(F.coalesce(is_bot, F.lit(False)), "BOT").when(anonymous, "ANONYMOUS").otherwise("REGISTERED")


def is_revert(tags: Column, comment: Column) -> Column:
    tagged = F.arrays_overlap(tags, F.array(*map(F.lit, REVERT_TAGS)))
    return F.coalesce(tagged, F.lit(False)) | F.coalesce(comment.rlike(REVERT_COMMENT), F.lit(False))


def revert_target(reverts: Column, comment: Column) -> Column:
    return F.when(reverts, F.nullif(F.regexp_extract(comment, UNDONE_REVISION, 1), F.lit("")).try_cast("long"))


def large_jump(delta: Column) -> Column:
    return F.coalesce(F.abs(delta) > LARGE_JUMP, F.lit(False))


def iso_millis(seconds: Column) -> Column:
    """Epoch seconds as 2024-01-01T00:00:00.000Z, cut to milliseconds."""
    return F.date_format(F.timestamp_micros(F.floor(seconds * 1_000_000).cast("long")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def float_text(x: Column) -> Column:
    """A double in plain digits with at least one decimal: 1700000000.0, 0.25."""
    digits = F.regexp_replace(x.cast("decimal(38,9)").cast("string"), "0+$", "")
    return F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)


def make_provenance(host: Column, epoch: Column, partition: Column, offset: Column) -> Column:
    return F.concat(host, F.lit(":"), epoch.cast("string"), F.lit(":part-"), partition.cast("string"), F.lit(":off-"), offset.cast("string"))


def rewrite_provenance(provenance: Column, host: Column, ingested: Column, partition: Column, offset: Column) -> Column:
    """Give an id its real partition and offset: replace its tail, append to host:epoch, or make one if there is none."""
    tail = F.concat(F.lit(":part-"), partition.cast("string"), F.lit(":off-"), offset.cast("string"))
    known = partition.isNotNull() & offset.isNotNull()
    empty = provenance.isNull() | (provenance == "")
    return (
        F.when(known & empty, F.concat(host, F.lit(":"), iso_millis(ingested), tail))
        .when(known & provenance.rlike(r":part-[^:]*:off-[^:]*$"), F.concat(F.regexp_replace(provenance, r":part-[^:]*:off-[^:]*$", ""), tail))
        .when(known & provenance.rlike(r"^[^:]*:[^:]*$"), F.concat(provenance, tail))
        .otherwise(provenance)
    )


def provenance_parts(provenance: Column) -> dict[str, Column]:
    """Node, epoch, partition and offset, split from the right, so that an ISO epoch keeps its colons."""
    pattern = r"^([^:]*):(.*):part-([^:]*):off-([^:]*)$"
    part = lambda i: F.nullif(F.regexp_extract(provenance, pattern, i), F.lit(""))
    return {"node": part(1), "epoch": part(2), "kafka_partition": part(3).try_cast("long"), "kafka_offset": part(4).try_cast("long")}


def latency_ms(later: Column, earlier: Column) -> Column:
    """Milliseconds between two epoch-second columns, three decimals; null if one is missing."""
    return F.round((later - earlier) * 1000, 3)


def probability(response: Column) -> Column:
    """output.probability.true of a JSON text, else its numeric probability with the smallest key, else null."""
    values = F.from_json(F.get_json_object(response, "$.output.probability"), "map<string,double>")
    rest = F.sort_array(F.map_entries(F.map_filter(values, lambda k, v: v.isNotNull())))
    return F.coalesce(values["true"], F.get(rest, F.lit(0))["value"])


def component_status(silent_seconds: Column, stale_after: float = 120.0) -> Column:
    return F.when(silent_seconds.isNull(), "no data").when(silent_seconds > stale_after, "stale").otherwise("ok")


def detail(details: Column, *path: str) -> Column:
    """A nested value of a JSON text as double; null if any level is missing."""
    return F.get_json_object(details, "$." + ".".join(path)).try_cast("double")
