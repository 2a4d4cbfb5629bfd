"""Text, hashing and header columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Unicode white space; Java's \s alone misses the no-break space and the separators.
WHITE = r"[\s\x1c-\x1f\x85\p{Z}]+"


def squeeze(c: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return F.btrim(F.regexp_replace(c, WHITE, " "))


def normalize_header(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def page_text(body: Column) -> Column:
    """Bytes as text; invalid sequences become replacement characters."""
    return F.make_valid_utf8(body.cast("string"))


def content_sha256(body: Column) -> Column:
    return F.sha2(body, 256)


def shard_of(key: Column, shards: int | Column, algorithm: str = "sha256") -> Column:
    """The key's whole hash, as a number, modulo the shards: 32 bits at a time, so nothing overflows."""
    n = (F.lit(shards) if isinstance(shards, int) else shards).cast("long")
    if isinstance(shards, int) and shards < 1:
        raise ValueError("the number of shards must be positive")
    digest, words = (F.sha2(key, 256), 8) if algorithm == "sha256" else (F.sha1(key), 5)
    part = F.transform(
        F.sequence(F.lit(0), F.lit(words - 1)),
        lambda i: F.conv(F.substring(digest, i * 8 + 1, F.lit(8)), 16, 10).cast("long"),
    )
    return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: (a * (F.lit(2**32) % n) + x) % n).cast("int")


def unique_keys(headers: DataFrame, group: list[str], label: str, pos: str, blank: str = "col_", numbered_blank: bool = True) -> DataFrame:
    """Adds key, blank and duplicate to rows of header labels. A blank label is col_<position> (or, with
    numbered_blank false, `col`); the n-th repeat of a key is <key>_<n>; a name made that way that is
    already taken gets the next free number."""
    base = normalize_header(F.col(label))
    name = F.when(base != "", base).otherwise(F.concat(F.lit(blank), F.col(pos).cast("string")) if numbered_blank else F.lit(blank.rstrip("_")))
    order = W.partitionBy(*group, "base").orderBy(pos)
    d = headers.withColumn("base", name).withColumn("blank", base == "").withColumn("n", F.row_number().over(order))
    d = d.withColumn("key", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat_ws("_", "base", F.col("n").cast("string"))))
    again = W.partitionBy(*group, "key").orderBy(pos)
    d = d.withColumn("taken", F.row_number().over(again))
    d = d.withColumn("key", F.when(F.col("taken") == 1, F.col("key")).otherwise(F.concat_ws("_", "key", F.col("taken").cast("string"))))
    return d.withColumn("duplicate", F.col("n") > 1).drop("base", "n", "taken")


def schema_fingerprint(keys: Column) -> Column:
    """SHA-256 of the compact JSON of the sorted distinct column names."""
    return F.sha2(F.to_json(F.array_sort(F.array_distinct(keys))), 256)


def contains_all(have: Column, want: Column) -> Column:
    return F.size(F.array_except(want, have)) == 0


# The verdicts' column names.
CANONICAL = ("player", "team", "season")
IDENTITY = ("player", "season")
CONTEXT = ("story", "description", "note", "headline")


def _names(*names: str) -> Column:
    return F.array(*[F.lit(n) for n in names])


def classify_surface(n_rows: Column, columns: Column, identifiers: Column) -> Column:
    """What a table can serve as; the first rule that holds."""
    known = contains_all(columns, identifiers)
    return (
        F.when(n_rows == 0, "unusable")
        .when(contains_all(identifiers, _names(*CANONICAL)) & known, "canonical_candidate")
        .when(contains_all(identifiers, _names(*IDENTITY)) & known, "identity_only")
        .when(F.arrays_overlap(columns, _names(*CONTEXT)), "context_only")
        .when((F.size(identifiers) > 0) & known, "corroborating_witness")
        .otherwise("unusable")
    )


CENSUS_IDS = ("player", "name", "team", "season", "year", "game", "date")
DISCOVERY_IDS = ("player", "team", "season", "year")
PILOT_HINTS = ("player", "team", "season", "year", "name", "date", "game", "opponent")


def _renamed(c: Column) -> Column:
    return F.when(c == "name", "player").when(c == "year", "season").otherwise(c)


def census_identifiers(columns: Column) -> Column:
    return F.array_distinct(F.transform(F.array_intersect(columns, _names(*CENSUS_IDS)), _renamed))


def census_columns(columns: Column, strict: bool = False) -> Column:
    """The columns that the identifiers are held against. strict leaves name and year as they are, so
    tables that have only those lose their verdict; by default both sides are renamed alike."""
    return columns if strict else F.array_distinct(F.concat(columns, F.transform(columns, _renamed)))


def discovery_identifiers(columns: Column) -> Column:
    return F.array_intersect(columns, _names(*DISCOVERY_IDS))


def pilot_identifiers(columns: Column) -> Column:
    return F.array_intersect(columns, _names(*PILOT_HINTS))


def detected_id_columns(headers: Column) -> Column:
    """Headers that are a hint or begin with one."""
    return F.filter(headers, lambda h: F.exists(_names(*PILOT_HINTS), lambda x: F.startswith(h, x)))


def has_native_id(href: Column) -> Column:
    return F.coalesce(href.rlike(r"(?i)/(?:p|t|l)-([A-Za-z0-9]+)|/([a-z']+\d+[a-z]?)\.html"), F.lit(False))


def stability(share: Column) -> Column:
    return F.when(share >= 0.9, "structural").when(share >= 0.5, "common").otherwise("variant")


def status_class(code: Column) -> Column:
    return (
        F.when(code.between(200, 299), "ok")
        .when(code == 404, "absent")
        .when(code == 429, "throttled")
        .when(code >= 500, "retryable")
        .when(code.isin(401, 403), "blocked")
        .otherwise("error")
    )


def is_total(label: Column) -> Column:
    return F.coalesce(F.lower(F.btrim(label)).isin("totals", "total"), F.lit(False))


#: Record columns that no source column may overwrite.
RESERVED = (
    "source", "dataset", "season", "team", "game_id", "player", "source_player_id", "source_url",
    "table_tag", "table_caption", "table_index", "row_class", "is_total_row", "game_team_ids",
)


def reserve(key: Column) -> Column:
    return F.when(key.isin(*RESERVED), F.concat(F.lit("stat_"), key)).otherwise(key)


def table_tag(caption: Column) -> Column:
    return F.nullif(normalize_header(caption), F.lit(""))


def put(base: Column, extra: Column) -> Column:
    """Map entries of extra replace those of base."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(extra), k)), extra)


def fumble_alias(view: Column, cells: Column) -> Column:
    """Game logs name fumbles `fum` and `lost`; both are kept under full names too."""
    both = F.map_contains_key(cells, F.lit("fum")) & F.map_contains_key(cells, F.lit("lost"))
    named = F.create_map(F.lit("fumbles"), F.try_element_at(cells, F.lit("fum")), F.lit("fumbles_lost"), F.try_element_at(cells, F.lit("lost")))
    return F.when((view == "logs") & both, put(cells, named)).otherwise(cells)
