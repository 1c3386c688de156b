"""Listing queries: views, reports, payload parsing, upserts, images.

Listings are bound to ``part`` (see ``bindings``); raw payloads and upsert
streams are rebuilt from ``events`` so that the JSON work grows with the
table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from propspark.constants import ENERGY_EXCLUDED, LIFT_LABELS, LISTING_PAYLOAD_KEYS
from propspark.functions import scalar as S
from propspark.operators import listings as L
from propspark.plans import views
from propspark.plans.bindings import ANNONCES_SQL, DIAGNOSTICS_SQL, annonces, diagnostics, table
from propspark.plans.registry import register, with_ctes
from propspark.sources.listings import LISTING_SCHEMA, cast_listing, payload_to_listing, type_listing

_EXCL = ", ".join(f"'{x}'" for x in ENERGY_EXCLUDED)


@register("listing_view", with_ctes(ANNONCES_SQL, DIAGNOSTICS_SQL) + """
SELECT a.*, d.dpe_valeur, d.dpe_lettre, d.ges_valeur, d.ges_lettre,
       ROUND(a.prix / NULLIF(a.surface, 0), 2) AS prix_m2
FROM annonces a LEFT JOIN diagnostics d ON a.id = d.id_annonce""")
def listing_view(spark, d):
    return views.listing_view(annonces(spark, d), diagnostics(spark, d))


@register("town_stats", with_ctes(ANNONCES_SQL) + """
SELECT ville, code_postal, COUNT(id) AS nb_annonces, ROUND(AVG(prix), 2) AS prix_moyen,
       ROUND(AVG(prix / surface), 2) AS prix_m2_moyen, ROUND(AVG(surface), 2) AS surface_moyenne,
       MIN(prix) AS prix_min, MAX(prix) AS prix_max
FROM annonces WHERE surface > 0 GROUP BY ville, code_postal ORDER BY nb_annonces DESC""")
def town_stats(spark, d):
    return views.town_stats(annonces(spark, d))


@register("type_stats", with_ctes(ANNONCES_SQL) + """
SELECT type, COUNT(id) AS nb_annonces, ROUND(AVG(prix), 2) AS prix_moyen,
       ROUND(AVG(prix / surface), 2) AS prix_m2_moyen, ROUND(AVG(surface), 2) AS surface_moyenne,
       ROUND(AVG(pieces), 1) AS pieces_moyenne
FROM annonces WHERE surface > 0 GROUP BY type ORDER BY nb_annonces DESC""")
def type_stats(spark, d):
    return views.type_stats(annonces(spark, d))


@register("energy_stats", with_ctes(ANNONCES_SQL, DIAGNOSTICS_SQL) + f"""
SELECT d.dpe_lettre, COUNT(a.id) AS nb_annonces, ROUND(AVG(a.prix), 2) AS prix_moyen,
       ROUND(AVG(a.prix / a.surface), 2) AS prix_m2_moyen
FROM annonces a JOIN diagnostics d ON a.id = d.id_annonce
WHERE d.dpe_lettre IS NOT NULL AND d.dpe_lettre NOT IN ({_EXCL}) AND a.surface > 0
GROUP BY d.dpe_lettre ORDER BY d.dpe_lettre""")
def energy_stats(spark, d):
    return views.energy_stats(annonces(spark, d), diagnostics(spark, d))


@register("listing_overview", with_ctes(ANNONCES_SQL) + """
SELECT type, COUNT(*) AS nb_annonces, ROUND(AVG(prix), 2) AS prix_moyen,
       ROUND(AVG(prix / surface), 2) AS prix_m2_moyen
FROM annonces WHERE surface > 0 GROUP BY type ORDER BY nb_annonces DESC""")
def listing_overview(spark, d):
    return views.listing_overview(annonces(spark, d))


@register("top_towns_having", with_ctes(ANNONCES_SQL) + """
SELECT ville, COUNT(*) AS nb_annonces, ROUND(AVG(prix / surface), 2) AS prix_m2_moyen
FROM annonces WHERE surface > 0 GROUP BY ville HAVING COUNT(*) >= 3
ORDER BY prix_m2_moyen DESC, ville LIMIT 5""")
def top_towns_having(spark, d):
    return views.top_towns(annonces(spark, d), min_listings=3, k=5)


@register("energy_distribution", with_ctes(ANNONCES_SQL, DIAGNOSTICS_SQL) + f"""
SELECT d.dpe_lettre, COUNT(*) AS nb_annonces, ROUND(AVG(a.prix), 2) AS prix_moyen
FROM annonces a JOIN diagnostics d ON a.id = d.id_annonce
WHERE d.dpe_lettre IS NOT NULL AND d.dpe_lettre NOT IN ({_EXCL})
GROUP BY d.dpe_lettre ORDER BY d.dpe_lettre""")
def energy_distribution(spark, d):
    return views.energy_distribution(annonces(spark, d), diagnostics(spark, d))


@register("lift_split", with_ctes(ANNONCES_SQL) + f"""
SELECT CASE WHEN ascenseur = 1 THEN '{LIFT_LABELS[0]}' ELSE '{LIFT_LABELS[1]}' END AS type_immeuble,
       COUNT(*) AS nb_annonces, ROUND(AVG(prix), 2) AS prix_moyen, ROUND(AVG(prix / surface), 2) AS prix_m2_moyen
FROM annonces WHERE surface > 0 AND type = 'ECONOMY' GROUP BY ascenseur""")
def lift_split(spark, d):
    return views.lift_split(annonces(spark, d), flat_type="ECONOMY")


@register("monthly_listings", with_ctes(ANNONCES_SQL) + """
SELECT strftime(date_publication, '%Y-%m') AS mois, COUNT(*) AS nb_annonces, ROUND(AVG(prix), 2) AS prix_moyen
FROM annonces GROUP BY mois ORDER BY mois DESC NULLS LAST LIMIT 6""")
def monthly_listings(spark, d):
    return views.monthly_listings(annonces(spark, d), k=6)


# ------------------------------------------------------------- raw payloads
# JSON values of a lift flag, by key, and what they count as.
LIFT_VALUES = [("0", 0), ('"0"', 1), ("false", 0), ('"false"', 1), ('""', 0), ("null", 0), ("true", 1), ("1", 1), ("0.0", 0), ("0.5", 1),
               ("-1", 1), ('"oui"', 1), ("[]", 0), ("[0]", 1), ("{}", 0), ('{"a": 0}', 1), (None, 0), ('" "', 1)]


def _lift_json(key: str):
    """The flag's JSON text by key; NULL where the field is missing."""
    return F.element_at(F.array(*[F.lit(v) for v, _ in LIFT_VALUES]), (F.col(key) % len(LIFT_VALUES) + 1).cast("int"))


_LIFT_SQL = f"[{', '.join(str(n) for _, n in LIFT_VALUES)}][event_id % {len(LIFT_VALUES)} + 1]::INTEGER"


@register("lift_truthiness", f"SELECT event_id, {_LIFT_SQL} AS ascenseur FROM events")
def lift_truthiness(spark, d):
    """F17 on listing records read from JSON, one for each kind of value."""
    lift = _lift_json("event_id")
    record = F.concat(F.lit('{"id": "x"'), F.coalesce(F.concat(F.lit(', "ascenseur": '), lift), F.lit("")), F.lit("}"))
    read = F.from_json(record, LISTING_SCHEMA)
    typed = type_listing(table(spark, d, "events").select("event_id", read.alias("r")).select("event_id", "r.*"))
    return typed.select("event_id", "ascenseur")


def _payloads(spark, d):
    """events -> raw agency payload JSON objects (Bien_* keys, adviser
    fields that must not survive, two image keys, one sometimes empty)."""
    e = table(spark, d, "events")
    k, u = F.col("event_id"), F.col("user_id")
    cents = (F.round(F.col("value") * 100)).cast("long")

    def letter(c):
        return F.when(c % 9 == 8, F.lit(None)).otherwise(F.substring(F.lit("ABCDEFG"), (c % 7 + 1).cast("int"), F.lit(1)))

    fields = {
        "id": k.cast("string"), "date_publication": F.date_format("ts", "yyyy-MM-dd"), "type": F.col("event_type"),
        "titre": F.concat(F.lit('Maison "'), u.cast("string"), F.lit('" à louer')), "prix": cents, "surface": u % 40 + 10,
        "pieces": k % 7, "chambres": F.when(k % 4 == 0, F.lit(None)).otherwise(k % 5), "etage": k % 12 - 1,
        "ville": F.concat(F.lit("Town"), (u % 10).cast("string")), "code_postal": F.lpad((u % 99999).cast("string"), 5, "0"),
        "latitude": 43 + (u % 700).cast("double") / 100, "longitude": -1 + (u % 900).cast("double") / 100,
        "etat": F.concat(F.lit("Etat"), (k % 3).cast("string")), "salle_de_bain": (k % 3).cast("string"),
        "chauffage_type": F.concat(F.lit("Gaz"), (k % 2).cast("string")), "chauffe_eau": F.lit("Ballon"),
        "exposition": F.when(k % 2 == 0, F.lit("Sud")), "dpe_valeur": k % 400, "dpe_lettre": letter(k), "ges_valeur": u % 90,
        "ges_lettre": letter(u), "charges_annuelles": F.when(k % 3 == 0, F.lit("")).otherwise((k % 2000).cast("string")),
        "description": F.concat(F.lit("ligne\n"), k.cast("string")), "image_principale": F.concat(F.lit("img/"), k.cast("string"), F.lit("/p")),
    }
    payload = F.to_json(F.struct(
        *[c.alias(LISTING_PAYLOAD_KEYS[name]) for name, c in fields.items()],
        F.struct((cents % 1000).alias("value")).alias(LISTING_PAYLOAD_KEYS["honoraires"]),
        F.lit("Jane Doe").alias("Bien_Conseiller_Nom"),
        F.lit("jane@example.org").alias("Bien_Conseiller_Email"),
        F.concat(F.lit("img/"), k.cast("string"), F.lit("/0")).alias("Image_0"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("img/"), k.cast("string"), F.lit("/1"))).alias("Image_1")))
    lift = F.coalesce(F.concat(F.lit(f', "{LISTING_PAYLOAD_KEYS["ascenseur"]}": '), _lift_json("event_id")), F.lit(""))
    return e.select("event_id", F.concat(F.substring(payload, F.lit(1), F.length(payload) - 1), lift, F.lit("}")).alias("payload"))


@register("payload_listing", f"""
SELECT CAST(event_id AS VARCHAR) AS id, 'https://listings.example/bien?id=' || CAST(event_id AS VARCHAR) AS url,
       strftime(ts, '%Y-%m-%d') AS date_publication, event_type AS type, 'Maison "' || user_id || '" à louer' AS titre,
       CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) AS prix, CAST(CAST(round(value * 100) AS BIGINT) % 1000 AS DOUBLE) AS honoraires,
       CAST(user_id % 40 + 10 AS DOUBLE) AS surface, CAST(event_id % 7 AS BIGINT) AS pieces,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 5 AS BIGINT) END AS chambres, CAST(event_id % 12 - 1 AS BIGINT) AS etage,
       {_LIFT_SQL} AS ascenseur, 'Town' || CAST(user_id % 10 AS VARCHAR) AS ville, lpad(CAST(user_id % 99999 AS VARCHAR), 5, '0') AS code_postal,
       43 + CAST(user_id % 700 AS DOUBLE) / 100 AS latitude, -1 + CAST(user_id % 900 AS DOUBLE) / 100 AS longitude,
       'Etat' || (event_id % 3) AS etat, CAST(event_id % 3 AS BIGINT) AS salle_de_bain, 'Gaz' || (event_id % 2) AS chauffage_type,
       'Ballon' AS chauffe_eau, CASE WHEN event_id % 2 = 0 THEN 'Sud' END AS exposition, CAST(event_id % 400 AS DOUBLE) AS dpe_valeur,
       CASE WHEN event_id % 9 <> 8 THEN substr('ABCDEFG', CAST(event_id % 7 + 1 AS BIGINT), 1) END AS dpe_lettre,
       CAST(user_id % 90 AS DOUBLE) AS ges_valeur,
       CASE WHEN user_id % 9 <> 8 THEN substr('ABCDEFG', CAST(user_id % 7 + 1 AS BIGINT), 1) END AS ges_lettre,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 2000 AS DOUBLE) END AS charges_annuelles,
       'ligne' || chr(10) || event_id AS description, 'img/' || event_id || '/p' AS image_principale,
       'img/' || event_id || '/0' || CASE WHEN event_id % 3 = 0 THEN '' ELSE '|img/' || event_id || '/1' END AS image_urls
FROM events""")
def payload_listing(spark, d):
    """S8 + P15 + F17-F19: all 29 columns of the record."""
    rec = cast_listing(type_listing(payload_to_listing(_payloads(spark, d))))
    return rec.select(*[f.name for f in LISTING_SCHEMA if f.name != "image_urls"], F.array_join("image_urls", "|").alias("image_urls"))


def _poly_events(spark, d):
    """prix as a number (key % 3 = 0), an object with value (key % 3 = 1) or an
    object with value 0 and a commission (key % 3 = 2); fees as number or
    object; charges as good text, empty text or junk."""
    e = table(spark, d, "events").select("event_id", F.round(F.col("value") * 100).cast("long").alias("c"))
    k = F.col("event_id") % 3
    prix = (F.when(k == 0, F.col("c").cast("string"))
            .when(k == 1, F.format_string('{"value": %d, "commission": 7}', F.col("c")))
            .otherwise(F.format_string('{"value": 0, "commission": %d}', F.col("c"))))
    fees = F.when(F.col("event_id") % 2 == 0, F.format_string('{"value": %d}', F.col("c") % 1000)) \
        .otherwise((F.col("c") % 1000).cast("string"))
    charges = (F.when(F.col("event_id") % 5 == 0, F.lit(""))
               .when(F.col("event_id") % 5 == 1, F.lit("n/a"))
               .otherwise((F.col("c") % 5000).cast("string")))
    return e.select(F.col("event_id").cast("string").alias("id"), prix.alias("prix"),
                    fees.alias("honoraires"), charges.alias("charges_annuelles"),
                    (F.col("event_id") % 2 == 0).alias("ascenseur"))


@register("polymorphic_price", """
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_id % 3 = 1 AND CAST(round(value * 100) AS BIGINT) = 0 THEN 7.0
            ELSE CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) END AS prix,
       CAST(CAST(round(value * 100) AS BIGINT) % 1000 AS DOUBLE) AS honoraires,
       CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS ascenseur
FROM events""")
def polymorphic_price(spark, d):
    typed = type_listing(_poly_events(spark, d))
    return typed.select("id", "prix", "honoraires", "ascenseur")


@register("tolerant_float", """
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_id % 5 IN (0, 1) THEN NULL
            ELSE CAST(CAST(round(value * 100) AS BIGINT) % 5000 AS DOUBLE) END AS charges_annuelles
FROM events""")
def tolerant_float(spark, d):
    typed = type_listing(_poly_events(spark, d))
    return typed.select("id", "charges_annuelles")


@register("upsert_last_wins", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT user_id, event_id, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def upsert_last_wins(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    return L.upsert_last_wins(e, key="user_id", seq="event_id")


def _part_images(spark, d):
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    img = lambda n: F.concat(F.lit("img/"), k.cast("string"), F.lit(f"/{n}"))
    arr = (F.when(k % 4 == 0, F.lit(None).cast("array<string>"))
           .when(k % 4 == 1, F.array(img(1), F.lit(""), img(3)))
           .otherwise(F.array(img(1), img(2))))
    main = F.when(k % 5 == 0, F.lit("")).otherwise(img(0))
    return p.select(k.cast("string").alias("id"), main.alias("image_principale"), arr.alias("image_urls"),
                    k.alias("ingest_seq"))


_IMG_SQL = """imgs AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, 0 AS n, 'img/' || CAST(p_partkey AS VARCHAR) || '/0' AS url, p_partkey % 5 <> 0 AS ok, 1 AS main FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 1, 'img/' || CAST(p_partkey AS VARCHAR) || '/1', p_partkey % 4 <> 0, 0 FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 2, CASE WHEN p_partkey % 4 = 1 THEN '' ELSE 'img/' || CAST(p_partkey AS VARCHAR) || '/2' END,
                   p_partkey % 4 <> 0, 0 FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 3, 'img/' || CAST(p_partkey AS VARCHAR) || '/3', p_partkey % 4 = 1, 0 FROM part)"""


@register("image_manifest", with_ctes(_IMG_SQL) + """
SELECT id AS id_annonce, CAST(n AS INTEGER) AS n, url AS url_image,
       id || '/image_' || CAST(n AS VARCHAR) || '.jpg' AS path
FROM imgs WHERE main = 0 AND ok AND url <> ''""")
def image_manifest(spark, d):
    return L.image_manifest(_part_images(spark, d))


@register("listing_images", with_ctes(_IMG_SQL) + """
SELECT id AS id_annonce, url AS url_image, main AS est_principale
FROM imgs WHERE ok AND url <> ''""")
def listing_images(spark, d):
    return L.image_rows(_part_images(spark, d)).select("id_annonce", "url_image", "est_principale")
