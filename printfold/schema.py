"""Fixed schemas and code lists of the catalogue."""

from pyspark.sql import types as T

_S = T.StringType()
_STRINGS = T.ArrayType(_S)
_URLS = T.MapType(_S, _S)


def _fields(*names, dtype=_S):
    return [T.StructField(n, dtype) for n in names]


FACE = T.StructType(
    _fields("name", "type_line", "oracle_text", "flavor_text", "mana_cost", "power", "toughness")
    + [T.StructField("image_uris", _URLS)]
)

# Only the fields some rule reads; everything else in the feed is skipped by the JSON parser.
FEED = T.StructType(
    _fields(
        "id", "oracle_id", "lang", "name", "layout", "released_at", "type_line", "mana_cost",
        "oracle_text", "flavor_text", "power", "toughness", "rarity", "set_name",
    )
    + [T.StructField("edhrec_rank", T.IntegerType())]
    + _fields("colors", "color_identity", "keywords", dtype=_STRINGS)
    + [
        T.StructField("legalities", _URLS),
        T.StructField("image_uris", _URLS),
        T.StructField("prices", T.StructType(_fields("usd", "tix"))),
        T.StructField("card_faces", T.ArrayType(FACE)),
    ]
)

# One element of the card store, as kept in a JSON document.
CARD_DOC = T.StructType(
    _fields("sid", "oracle_id", "date", "name", "layout")
    + [
        T.StructField("colors", _STRINGS),
        T.StructField("legalities", T.MapType(_S, T.BooleanType())),
        T.StructField("rarity", _S),
        T.StructField("keywords", _STRINGS),
    ]
    + _fields("front", "back", "art", "type")
    + _fields("subtypes", "texts", "mana_costs", dtype=_STRINGS)
    + [T.StructField("total_mana_cost", T.IntegerType())]
    + _fields("face_names", "flavor_texts", dtype=_STRINGS)
    + _fields("power", "toughness", "set_name")
    + [
        T.StructField("edh_rank", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("tix", T.DoubleType()),
        T.StructField("name_key", _S),
    ]
)

# Fixed values.
FORMATS = (
    "standard", "future", "historic", "gladiator", "pioneer", "explorer", "modern", "legacy",
    "pauper", "vintage", "penny", "commander", "oathbreaker", "brawl", "historicbrawl", "alchemy",
    "paupercommander", "duel", "oldschool", "premodern", "predh",
)

# Fixed values.
COLORS = {"W": 1, "U": 2, "B": 3, "R": 4, "G": 5}

# Fixed values.
RARITIES = {"common": 1, "uncommon": 2, "rare": 3, "mythic": 4}

# Image sizes, best first.
IMAGE_SIZES = ("png", "large", "normal", "small", "border_crop")

# Layouts whose two faces carry their own pictures.
TWO_SIDED_LAYOUTS = ("modal_dfc", "transform")

# Names and type heads that keep a printing out of the catalogue.
EXCLUDED_NAME = r"World{blank}Championships?{blank}Ad"
EXCLUDED_TYPES = ("Card",)

# Defaults of the main table.
DEFAULT_PRICE = 100
DEFAULT_RANK = 99999

# Child table -> (list column of the card, value column of the table).
CHILDREN = {
    "card_subtypes": ("subtypes", "subtype"),
    "card_keywords": ("keywords", "keyword"),
    "card_flavor_text": ("flavor_texts", "text"),
    "card_texts": ("texts", "text"),
    "card_names": ("face_names", "name"),
    "card_colors": ("colors", "color_id"),
}

CARDS = T.StructType(
    _fields("id", "oracle_id", "name", "layout", "front", "back", "art")
    + _fields("rarity", dtype=T.IntegerType())
    + _fields("type")
    + _fields("toughness", "power", dtype=T.IntegerType())
    + _fields("manaCost")
    + _fields("totalManaCost", *FORMATS, "edh_rank", dtype=T.IntegerType())
    + _fields("price", dtype=T.DoubleType())
    + _fields("set_name")
)


def child_schema(table):
    """Schema of a child table: id, card_id and one value."""
    if table == "card_prints":
        return T.StructType(_fields("id", "card_id") + _fields("released", dtype=T.IntegerType()))
    _, value = CHILDREN[table]
    dtype = T.IntegerType() if table == "card_colors" else _S
    return T.StructType(_fields("id", "card_id") + _fields(value, dtype=dtype))
