"""Listing sources.

A listing file is a JSON array (or JSON lines for large drops).  ``prix``
and ``honoraires`` are polymorphic (a number or an object), so they are
read as raw JSON text and typed with ``polymorphic_price``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propspark.constants import (LISTING_IMAGE_KEYS, LISTING_PAYLOAD_KEYS, LISTING_PII_KEYS,
                                 LISTING_URL_FORMAT)
from propspark.functions.scalar import (polymorphic_price, polymorphic_value, tolerant_float,
                                        truthy_int, truthy_variant)

LISTING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("date_publication", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("titre", T.StringType()),
    T.StructField("prix", T.StringType()), T.StructField("honoraires", T.StringType()),
    T.StructField("surface", T.DoubleType()), T.StructField("pieces", T.LongType()),
    T.StructField("chambres", T.LongType()), T.StructField("etage", T.LongType()),
    T.StructField("ascenseur", T.VariantType()), T.StructField("ville", T.StringType()),
    T.StructField("code_postal", T.StringType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("etat", T.StringType()),
    T.StructField("salle_de_bain", T.LongType()), T.StructField("chauffage_type", T.StringType()),
    T.StructField("chauffe_eau", T.StringType()), T.StructField("exposition", T.StringType()),
    T.StructField("dpe_valeur", T.DoubleType()), T.StructField("dpe_lettre", T.StringType()),
    T.StructField("ges_valeur", T.DoubleType()), T.StructField("ges_lettre", T.StringType()),
    T.StructField("charges_annuelles", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("image_principale", T.StringType()),
    T.StructField("image_urls", T.ArrayType(T.StringType())),
])


def read_listings(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """Listing records with a fixed schema and an ingest sequence (file
    time, file, block, position) used for last-wins upserts: a newer file
    wins whatever its size.  Polymorphic fields stay JSON text; see
    ``type_listing``."""
    df = (spark.read.schema(LISTING_SCHEMA).option("multiLine", multiline)
          .option("primitivesAsString", False).json(path))
    # Splits are numbered by size, but within a file block positions ascend.
    seq = F.struct(F.col("_metadata.file_modification_time").alias("mtime"), F.col("_metadata.file_path").alias("path"),
                   F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
    return df.withColumn("ingest_seq", seq).withColumn("_source_file", F.col("_metadata.file_path"))


def type_listing(df: DataFrame) -> DataFrame:
    """Typed price, fees, lift flag and annual charges.  ``prix`` and
    ``honoraires`` hold the raw JSON text of a number or an object,
    ``ascenseur`` a JSON value with its type (or a plain column)."""
    varies = isinstance(df.schema["ascenseur"].dataType, T.VariantType)
    return df.withColumns({
        "prix": polymorphic_price("prix"),
        "honoraires": polymorphic_value("honoraires"),
        "ascenseur": (truthy_variant if varies else truthy_int)("ascenseur"),
        "charges_annuelles": tolerant_float("charges_annuelles"),
    })


def cast_listing(df: DataFrame) -> DataFrame:
    """Text fields of a listing record as the numbers of ``LISTING_SCHEMA``;
    what does not parse is NULL."""
    numbers = {f.name: f.dataType.simpleString() for f in LISTING_SCHEMA if isinstance(f.dataType, T.NumericType)}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in numbers.items() if c in df.columns})


def payload_schema(image_keys=LISTING_IMAGE_KEYS) -> T.StructType:
    """Every payload key we select, as STRING: nested objects (a polymorphic
    price) arrive as their JSON text.  The lift flag keeps its JSON type.
    Personal-data keys are not in the schema, so they are never even parsed
    into a column."""
    keys = list(LISTING_PAYLOAD_KEYS.values()) + list(image_keys)
    return T.StructType([T.StructField(k, T.VariantType() if k == LISTING_PAYLOAD_KEYS["ascenseur"] else T.StringType()) for k in keys])


def payload_to_listing(raw_json: DataFrame, json_col: str = "payload",
                       url_format: str = LISTING_URL_FORMAT,
                       image_keys=LISTING_IMAGE_KEYS) -> DataFrame:
    """S8 + P15: raw agency payload (one JSON object per row) -> listing record.

    One ``from_json`` parse per row against an allow-list schema; adviser /
    agency fields are not in it.  ``image_urls`` collects the non-empty
    image keys in key order; the URL is built from the reference.
    """
    p = F.from_json(F.col(json_col), payload_schema(image_keys))
    parsed = raw_json.select(p.alias("_p"))

    def field(k):
        return F.col("_p")[k]

    images = F.filter(F.array(*[field(k) for k in image_keys]), lambda u: u.isNotNull() & (u != ""))
    ident = field(LISTING_PAYLOAD_KEYS["id"])
    out = parsed.select(
        ident.alias("id"),
        F.format_string(url_format, ident).alias("url"),
        *[field(src).alias(dst) for dst, src in LISTING_PAYLOAD_KEYS.items() if dst != "id"],
        images.alias("image_urls"))
    for k in LISTING_PII_KEYS:
        assert k not in out.columns
    return out
