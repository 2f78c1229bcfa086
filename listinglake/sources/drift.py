"""What landed listings hold, against what is declared, capture by capture.

Members and their types are found by aggregates over the entries themselves
(``schema_of_variant_agg`` per member), so nothing is inferred from a sample and no schema is
merged on the driver. A capture is one row per member: the declared ones and all others it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake import schemas

UNKNOWN, ABSENT, OTHER_TYPE, AS_DECLARED = "unknown", "absent", "other type", "as declared"
#: Types found in JSON that a declared type takes as they are; null fits every type.
_FITS = {
    "string": ("STRING",),
    "bigint": ("BIGINT",),
    "int": ("BIGINT",),
    "double": ("DOUBLE", "DECIMAL", "BIGINT"),
    "boolean": ("BOOLEAN",),
}


def members(entries: DataFrame, capture: str = "file", entry: str = "entry") -> DataFrame:
    """(capture, listings, member, present, found): each member of the listing objects.

    ``entry`` is raw JSON text; entries that are no objects do not count. ``found`` is the type
    that holds all values of the member in the capture, ``present`` how many listings have it.
    A listing without any member still counts as one.
    """
    parsed = entries.select(F.col(capture).alias("capture"), F.from_json(entry, "map<string,variant>").alias("held"))
    objects = parsed.where(F.col("held").isNotNull() & F.ltrim(entry).startswith("{"))
    each = objects.select("capture", F.explode_outer("held").alias("member", "value"))
    found = each.where("member IS NOT NULL").groupBy("capture", "member").agg(
        F.count(F.lit(1)).alias("present"), F.schema_of_variant_agg("value").alias("found")
    )
    totals = objects.groupBy("capture").agg(F.count(F.lit(1)).alias("listings"))
    return totals.join(found, "capture", "left").select("capture", "listings", "member", "present", "found")


def drift(
    entries: DataFrame, declared: str = schemas.BRONZE, capture: str = "file", entry: str = "entry"
) -> DataFrame:
    """(capture, member, declared, found, present, listings, status), per capture.

    One row for each declared member and each other one: ``unknown`` is not declared, ``absent``
    is in no listing, ``other type`` does not fit, the rest is ``as declared``. A member that only
    some listings have shows by ``present`` below ``listings``.
    """
    names = schemas.fields(declared)
    found = members(entries, capture, entry)
    wanted = F.explode(F.array(*[F.struct(F.lit(n).alias("member"), F.lit(k).alias("declared")) for n, k in names]))
    expected = found.select("capture", "listings").distinct().select("capture", "listings", wanted.alias("at"))
    both = expected.select("capture", "listings", "at.*").join(
        found.where("member IS NOT NULL").withColumnRenamed("listings", "_listings"), ["capture", "member"], "full"
    )
    kind = F.regexp_extract("found", r"^[A-Z]+", 0)
    fits = kind == "VOID"
    for name, kinds in _FITS.items():
        fits = fits | ((F.col("declared") == name) & kind.isin(*kinds))
    status = (
        F.when(F.col("declared").isNull(), UNKNOWN)
        .when(F.col("found").isNull(), ABSENT)
        .when(fits, AS_DECLARED)
        .otherwise(OTHER_TYPE)
    )
    return both.select(
        "capture",
        "member",
        "declared",
        "found",
        F.coalesce("present", F.lit(0)).cast("bigint").alias("present"),
        F.coalesce("listings", "_listings").alias("listings"),
        status.alias("status"),
    )
