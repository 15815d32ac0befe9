"""Record preparation (P1, P5-P15): raw rows -> clean, validated collection records.

Everything is one narrow ``select`` (no shuffle, no Python): each raw row
becomes ``(id, document, <typed fields>, invalid_reason, metadata)``.

Semantics (SURVEY §1.4.7-9):
* validation checks user_rating in [0, 5], price >= 0, reviews >= 0, year in
  [1900, 2100] in that order and reports the first failure;
* an invalid row is *kept* with its text fields sanitized (no length cap,
  empty -> "Unknown") and every number reset (0.0, 0, 0.0, year 2000);
* a valid row keeps empty text as "" and caps name/author at 500/200;
* document text = strip(sanitize(Name) + " " + sanitize(Author)), uncapped;
* the stored metadata goes through the JSON-safe cleaning twice (once when
  the record is built, once when the batch is validated), the document once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import clean_float, clean_int
from quarry.functions.text import (
    AUTHOR_MAX,
    NAME_MAX,
    document_text,
    json_safe,
    or_default,
    sanitize,
)

# Source column -> field name, and the validation ranges.
SOURCE_COLUMNS = {
    "Name": "name",
    "Author": "author",
    "User Rating": "user_rating",
    "Reviews": "reviews",
    "Price": "price",
    "Year": "year",
    "Genre": "genre",
}
FIELDS = ["name", "author", "user_rating", "reviews", "price", "year", "genre"]
RATING_MIN, RATING_MAX = 0.0, 5.0
YEAR_MIN, YEAR_MAX = 1900, 2100
DEFAULT_YEAR = 2000
RECORD_SCHEMA = (
    "id string, document string, name string, author string, user_rating double, "
    "reviews bigint, price double, year bigint, genre string, invalid_reason string, metadata string"
)


def validation_reason(rating: Column, price: Column, reviews: Column, year: Column) -> Column:
    """P10 — name of the first failing field, null when the row is valid."""
    return (
        F.when(rating.isNull() | ~rating.between(RATING_MIN, RATING_MAX), F.lit("user_rating"))
        .when(price.isNull() | (price < 0.0), F.lit("price"))
        .when(reviews.isNull() | (reviews < 0), F.lit("reviews"))
        .when(year.isNull() | ~year.between(YEAR_MIN, YEAR_MAX), F.lit("year"))
    )


def metadata_json(df_cols: dict[str, Column]) -> Column:
    """P13 — compact JSON object with the fields in declaration order."""
    return F.to_json(F.struct(*[df_cols[f].alias(f) for f in FIELDS]))


def prepare_records(raw: DataFrame, id_col: Column | str | None = None) -> DataFrame:
    """P15 — the whole preparation of raw book rows (columns as in ``SOURCE_COLUMNS``).

    ``id_col`` gives the record id (P1): a key column cast to string.  When
    absent, the row position is used (``with_row_ids``).
    """
    if id_col is None:
        raw = with_row_ids(raw, "_row_id")
        id_col = "_row_id"
    rid = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string")
    types = {f.name: f.dataType for f in raw.schema.fields}

    def src(name: str) -> Column:
        return F.col(f"`{name}`")

    name_s, author_s, genre_s = sanitize(src("Name")), sanitize(src("Author")), sanitize(src("Genre"))
    rating = clean_float(src("User Rating"), types["User Rating"])
    price = clean_float(src("Price"), types["Price"])
    reviews = clean_int(src("Reviews"), types["Reviews"])
    year = clean_int(src("Year"), types["Year"])

    stage1 = raw.select(
        rid.alias("id"),
        json_safe(document_text(src("Name"), src("Author"))).alias("document"),
        name_s.alias("_name"),
        author_s.alias("_author"),
        genre_s.alias("_genre"),
        rating.alias("_rating"),
        price.alias("_price"),
        reviews.alias("_reviews"),
        year.alias("_year"),
    )
    reason = validation_reason(F.col("_rating"), F.col("_price"), F.col("_reviews"), F.col("_year"))
    stage2 = stage1.withColumn("invalid_reason", reason)
    ok = F.col("invalid_reason").isNull()

    def twice(c: Column) -> Column:
        return json_safe(json_safe(c))

    fields = {
        "name": twice(F.when(ok, F.substring("_name", 1, NAME_MAX)).otherwise(or_default(F.col("_name")))),
        "author": twice(F.when(ok, F.substring("_author", 1, AUTHOR_MAX)).otherwise(or_default(F.col("_author")))),
        "user_rating": F.when(ok, F.col("_rating")).otherwise(F.lit(0.0)),
        "reviews": F.when(ok, F.col("_reviews")).otherwise(F.lit(0).cast("long")),
        "price": F.when(ok, F.col("_price")).otherwise(F.lit(0.0)),
        "year": F.when(ok, F.col("_year")).otherwise(F.lit(DEFAULT_YEAR).cast("long")),
        "genre": twice(F.when(ok, F.col("_genre")).otherwise(or_default(F.col("_genre")))),
    }
    stage3 = stage2.select("id", "document", *[c.alias(f) for f, c in fields.items()], "invalid_reason")
    return stage3.withColumn("metadata", metadata_json({f: F.col(f) for f in FIELDS}))


def with_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """P1 fallback — consecutive row positions (0, 1, 2, ...) in scan order, JVM only.

    ``monotonically_increasing_id`` is ``partition << 33 | row-in-partition``;
    one aggregate counts the rows of every partition, a running sum over those
    counts (one row per partition, never the data) gives each partition's
    first position, and a join on the partition number adds it.  No sort or
    single task sees the rows.  The input must have a deterministic
    partitioning (a file scan has).
    """
    tagged = df.withColumn("_mono", F.monotonically_increasing_id()).withColumn("_pid", F.shiftright("_mono", 33))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    pos = F.col("_start") + F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1))
    return tagged.join(starts, "_pid").withColumn(name, pos).select(*[F.col(f"`{c}`") for c in df.columns], name)


def validation_summary(records: DataFrame) -> DataFrame:
    """P12 — rows per validation outcome (``invalid_reason`` null = valid)."""
    return records.groupBy("invalid_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def validation_error_count(records: DataFrame) -> DataFrame:
    """P12 — one row: total records and records that fell back to defaults."""
    return records.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col("invalid_reason").isNotNull()).alias("n_invalid"),
    )


def storable() -> Column:
    """P14 — a record can be stored when its document and metadata are JSON-clean.

    After ``json_safe`` every string is; the metadata must also parse.
    """
    parses = F.get_json_object(F.col("metadata"), "$").isNotNull()
    return F.coalesce(F.col("document").isNotNull() & F.col("metadata").isNotNull() & parses, F.lit(False))


def batch_validate(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P14 / S4 split — (storable, quarantine); rejects are returned, never silently dropped."""
    flagged = records.withColumn("_storable", storable())
    return (
        flagged.where("_storable").drop("_storable"),
        flagged.where(~F.col("_storable")).drop("_storable"),
    )


def batch_numbers(n_rows: Column, batch_size: int = 100) -> Column:
    """A8 — number of batches ``ceil(n / batch_size)``."""
    return F.ceil(n_rows / F.lit(batch_size)).cast("long")


def batch_id(position: Column, batch_size: int = 100) -> Column:
    """A8 — batch a row falls into: ``floor(position / batch_size)``."""
    return F.floor(position / F.lit(batch_size)).cast("long")
