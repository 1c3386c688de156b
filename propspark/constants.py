"""Domain vocabularies.

FIXED VALUES: everything in this module must equal the values of the
property-sales pipeline this engine reproduces (column names of the national
sale files, point-of-interest categories, their search radii and tag rules,
French month abbreviations, the literal commune population table).  They are
stated plainly, in their natural order.
"""

# ---------------------------------------------------------------- fixed values
# Raw sale file columns, in file order (all read as STRING).
RAW_SALES_COLUMNS = [
    "id_mutation", "date_mutation", "numero_disposition", "nature_mutation",
    "valeur_fonciere", "adresse_numero", "adresse_suffixe", "adresse_nom_voie",
    "adresse_code_voie", "code_postal", "code_commune", "nom_commune",
    "code_departement", "ancien_code_commune", "ancien_nom_commune", "id_parcelle",
    "ancien_id_parcelle", "numero_volume", "lot1_numero", "lot1_surface_carrez",
    "lot2_numero", "lot2_surface_carrez", "lot3_numero", "lot3_surface_carrez",
    "lot4_numero", "lot4_surface_carrez", "lot5_numero", "lot5_surface_carrez",
    "nombre_lots", "code_type_local", "type_local", "surface_reelle_bati",
    "nombre_pieces_principales", "code_nature_culture", "nature_culture",
    "code_nature_culture_speciale", "nature_culture_speciale", "surface_terrain",
    "longitude", "latitude", "section_prefixe",
]

# Columns kept after the first cleaning pass.
KEPT_SALES_COLUMNS = [
    "date_mutation", "valeur_fonciere", "code_postal", "nom_commune", "code_commune",
    "nature_mutation", "code_departement", "id_parcelle", "type_local",
    "surface_reelle_bati", "surface_terrain", "longitude", "latitude", "adresse_numero",
    "adresse_suffixe", "adresse_nom_voie", "adresse_code_voie",
]

# Sale natures that count as sales, and the local types kept.
SALE_NATURES = ["Vente", "Vente en l'état futur d'achèvement", "Vente terrain à bâtir"]
PLAIN_SALE = "Vente"
LOCAL_TYPES = ["Appartement", "Maison"]

# Dedup key of the first cleaning pass.
SALES_DEDUP_KEY = ["date_mutation", "longitude", "latitude", "valeur_fonciere", "surface_terrain"]

# Point-of-interest categories, in this order, with radius in metres.
POI_CATEGORIES = ["gares", "commerces", "education", "espaces_verts", "sante",
                  "pharmacies", "aeroports", "routes_principales", "industries"]
POI_RADIUS_M = {
    "gares": 1500,
    "commerces": 500,
    "education": 1000,
    "espaces_verts": 500,
    "sante": 1000,
    "pharmacies": 500,
    "aeroports": 30000,
    "routes_principales": 1500,
    "industries": 1000,
}
# Tag rules: category -> {tag key: allowed values (True = any value)}.
POI_TAG_RULES = {
    "gares": {"public_transport": ["station"]},
    "commerces": {"shop": ["supermarket", "convenience"]},
    "education": {"amenity": ["school", "university"]},
    "espaces_verts": {"leisure": ["park"]},
    "sante": {"amenity": ["hospital", "clinic", "doctors"]},
    "pharmacies": {"amenity": ["pharmacy"]},
    "aeroports": {"aeroway": ["aerodrome"]},
    "routes_principales": {"highway": ["motorway", "trunk"]},
    "industries": {"man_made": ["works"]},
}
# Same-name POI dedup threshold, metres (inclusive).
POI_DEDUP_THRESHOLD_M = 25.0

# French month abbreviations used by the macro series labels ("janv. 2015").
FRENCH_MONTHS = {
    "janv.": 1, "févr.": 2, "mars": 3, "avr.": 4, "mai": 5, "juin": 6,
    "juil.": 7, "août": 8, "sept.": 9, "oct.": 10, "nov.": 11, "déc.": 12,
}
MACRO_START = "2015-01-01"

# Census text that stands for "no value".
CENSUS_NULL_TEXT = "N/A - résultat non disponible"
DEPARTMENT_CODE_PATTERN = r"^(\d{2,3}|2[AB])$"
COMMUNE_CODE_PATTERN = r"^\d[0-9AB]\d{3}$"

# Literal commune populations used to estimate missing household counts
# (households = round(population / 2.2)).
COMMUNE_POPULATION = [
    ("13215", 14497), ("75115", 227746), ("13207", 12888), ("75120", 189805),
    ("64541", 310), ("13210", 9619), ("13204", 20094), ("85041", 302),
    ("75105", 56841), ("75116", 162061), ("75108", 35123), ("13211", 57924),
    ("13206", 39647), ("85271", 85000), ("75107", 47947), ("75101", 15919),
    ("75106", 48905), ("13208", 82609), ("49321", 390), ("75103", 32793),
    ("75114", 136368), ("75104", 28324), ("13202", 23627), ("69382", 30485),
    ("69384", 35603), ("69381", 29016), ("75119", 181616), ("13213", 92261),
    ("69385", 48711), ("69152", 10515), ("13205", 45449), ("75111", 142583),
    ("75117", 164413), ("13209", 77106), ("13212", 20829), ("75118", 188446),
    ("13203", 53115), ("75112", 140954), ("13216", 15487), ("75110", 95394),
    ("69386", 52007), ("69383", 101302), ("75102", 21119), ("75109", 58951),
    ("13214", 59948), ("69387", 85897), ("86231", 478), ("69388", 86326),
    ("13201", 39436), ("75113", 178350), ("69389", 52903),
]
PERSONS_PER_HOUSEHOLD = 2.2

# Listing value lists (CHECK constraints of the listing tables).
LISTING_TYPES = ["Appartement", "Maison", "Maison de ville", "Duplex", "Loft", "Chalet",
                 "Terrain", "Parking", "Box", "Commerce", "Immeuble"]
LISTING_STATES = ["Neuf", "Excellent état", "Bon état", "À rafraîchir", "À rénover"]
ENERGY_LETTERS = ["A", "B", "C", "D", "E", "F", "G", "Not applicable", "In progress"]
ENERGY_EXCLUDED = ["Not applicable", "In progress"]
PROPERTY_TYPES = ["Maison", "Appartement", "Dépendance", "Local industriel. commercial ou assimilé"]

# Interest-rate bands: (upper bound exclusive, label); last label is "else".
RATE_BANDS = [(2, "Taux < 2%"), (3, "Taux 2-3%"), (4, "Taux 3-4%")]
RATE_BAND_ELSE = "Taux >= 4%"
LIFT_LABELS = ("Avec ascenseur", "Sans ascenseur")

# Raw listing payload key -> listing field.
LISTING_PAYLOAD_KEYS = {
    "id": "Bien_Reference",
    "date_publication": "Bien_Date",
    "type": "Bien_Type",
    "titre": "Bien_Libellés",
    "prix": "Bien_Prix",
    "honoraires": "Bien_Honoraires",
    "surface": "Bien_Surface",
    "pieces": "Bien_Nb_Pieces",
    "chambres": "Bien_Nb_Chambres",
    "etage": "Bien_Etage_Immeuble",
    "ascenseur": "Bien_Ascenseur",
    "ville": "Bien_Ville",
    "code_postal": "Bien_Code_Postal",
    "latitude": "Bien_Latitude",
    "longitude": "Bien_Longitude",
    "etat": "Bien_Etat",
    "salle_de_bain": "Bien_Nb_Sdb",
    "chauffage_type": "Bien_Chauffage_Nature_Type",
    "chauffe_eau": "Bien_Chauffe_Eau_Type",
    "exposition": "Bien_Exposition",
    "dpe_valeur": "Bien_DPE",
    "dpe_lettre": "Bien_DPE_Letter",
    "ges_valeur": "Bien_GES",
    "ges_lettre": "Bien_GES_Letter",
    "charges_annuelles": "Bien_Charges_Courantes_Provisionnelles",
    "description": "Bien_Description",
    "image_principale": "Bien_Image_1",
}
LISTING_IMAGE_KEYS = ["Image_0", "Image_1"]
# The agency site address is a deployment parameter, not a fixed value.
LISTING_URL_FORMAT = "https://listings.example/bien?id=%s"
IMAGE_PATH_FORMAT = "%s/image_%d.jpg"
# Personal data that must never be selected from a payload.
LISTING_PII_KEYS = ["Bien_Conseiller_Nom", "Bien_Conseiller_Email",
                    "Bien_Conseiller_Telephone", "Bien_Conseiller_Agence"]
# ------------------------------------------------------------ end fixed values

