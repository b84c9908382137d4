"""Scalar rules as Column expressions; all run inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from printfold.schema import DEFAULT_PRICE, DEFAULT_RANK, FORMATS, IMAGE_SIZES

# The blanks a trim removes and ``\s`` matches in the feed's own rules.
BLANKS = (
    "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
BLANK = r"[\s\x0B\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"

# All but a-z, 0-9, "-", "_" and the space.
DROPPED = r"[\x00-\x1f\x21-\x2c./:-^`\x{7b}-\x{10ffff}]+"

# Symbols worth one in a cost; digits are worth themselves.
COST_LETTERS = "RUBGWS"


def nonempty(c: Column) -> Column:
    """The string, or null when it is empty."""
    return F.nullif(c, F.lit(""))


def truthy(c: Column, empty) -> Column:
    """The value, or null when it equals the type's empty value ('' or 0)."""
    return F.nullif(c, F.lit(empty))


def trim(c: Column) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.btrim(c, F.lit(BLANKS))


def nonempty_items(items: Column) -> Column:
    """Array without its null and empty strings, order kept."""
    return F.filter(items, lambda x: x != "")


# -- choosing among values ----------------------------------------------------------------------


def pick_first(m: Column, keys) -> Column:
    """First non-empty map value in key order, else the map's first value; empty is null.

    The map goes through a one-item array so that the plan holds its expression once, not once per
    key, however often the result is filtered on.
    """

    def pick(m):
        values = F.array(*[m[k] for k in keys], F.get(F.map_values(m), F.lit(0)))
        return F.get(nonempty_items(values), F.lit(0))

    return F.get(F.transform(F.array(m), pick), F.lit(0))


def pick_image(m: Column) -> Column:
    return pick_first(m, IMAGE_SIZES)


def art_crop(m: Column) -> Column:
    return nonempty(m["art_crop"])


def first_list(*lists: Column) -> Column:
    """First list that is not null (an empty one counts), else an empty list."""
    return F.coalesce(*lists, F.array().cast("array<string>"))


def final_price(price: Column, tix: Column, default=DEFAULT_PRICE) -> Column:
    """First of price and tix that is neither null nor zero, else the default."""
    return F.coalesce(truthy(price, 0.0), truthy(tix, 0.0), F.lit(float(default)))


def final_rank(rank: Column, default=DEFAULT_RANK) -> Column:
    return F.coalesce(rank, F.lit(default))


def media_columns(layout: Column, faces: Column, images: Column, two_sided) -> dict:
    """front, back and art of a printing, by its layout.

    Two-sided layouts show their first two faces; other layouts with faces show the top-level
    picture on both sides; a printing without faces has no back.
    """
    faced = has_items(faces)
    paired = faced & F.coalesce(layout.isin(*two_sided), F.lit(False))
    front = F.when(paired, F.get(faces, F.lit(0))["image_uris"]).otherwise(images)
    back = F.when(paired, F.get(faces, F.lit(1))["image_uris"]).when(faced, images)
    return {"front": pick_image(front), "back": pick_image(back), "art": art_crop(front)}


def has_items(items: Column) -> Column:
    """True for a non-empty array; null and empty are False."""
    return F.coalesce(F.size(items) > 0, F.lit(False))


# -- faces --------------------------------------------------------------------------------------


def collect_faces(faces: Column, top: Column, field: str) -> Column:
    """Non-empty values of a field over the faces in order, else the top-level one as a list."""
    return nonempty_items(
        F.when(has_items(faces), F.transform(faces, lambda f: f[field])).otherwise(F.array(top))
    )


def type_pieces(line: Column, sep="—") -> Column:
    """Pieces of a type line between separators, trimmed; null for a missing line."""
    return F.transform(F.split(line, rf"\Q{sep}\E"), trim)


def type_head(line: Column, sep="—") -> Column:
    """What precedes the first separator, trimmed."""
    return trim(F.substring_index(line, sep, 1))


def type_tail(line: Column, sep="—") -> Column:
    """Every piece after the first, trimmed; inner spaces are not split."""
    pieces = type_pieces(line, sep)
    return F.coalesce(
        F.slice(pieces, F.lit(2), F.greatest(F.size(pieces), F.lit(1))),
        F.array().cast("array<string>"),
    )


def face_type_head(faces: Column, sep="—") -> Column:
    """First non-empty head over the faces; '' when every line has an empty head."""
    lines = F.filter(F.transform(faces, lambda f: f["type_line"]), lambda x: x.isNotNull())
    heads = F.transform(lines, lambda x: type_head(x, sep))
    return F.coalesce(F.get(nonempty_items(heads), F.lit(0)), F.get(heads, F.lit(0)))


def face_type_tail(faces: Column, sep="—") -> Column:
    """Tails of all faces, one after the other."""
    return F.flatten(F.transform(faces, lambda f: type_tail(f["type_line"], sep)))


def stats_columns(faces: Column, power: Column, toughness: Column, default="0") -> dict:
    """power and toughness: face 0's once any face has both, else the top-level pair, else 0."""
    both = F.exists(
        faces,
        lambda f: nonempty(f["power"]).isNotNull() & nonempty(f["toughness"]).isNotNull(),
    )
    faced = has_items(faces)
    top = nonempty(power).isNotNull() & nonempty(toughness).isNotNull()
    face0 = F.get(faces, F.lit(0))

    def pick(name, top_value):
        return (
            F.when(faced & both, face0[name])
            .when(~faced & top, top_value)
            .otherwise(F.lit(default))
        )

    return {"power": pick("power", power), "toughness": pick("toughness", toughness)}


# -- numbers ------------------------------------------------------------------------------------


def cost_value(c: Column) -> Column:
    """Sum over a cost's symbols: each digit its own value, each coloured letter one, null 0.

    One pass keeps the symbols; each then counts one, and a digit its value less one on top.
    """
    symbols = F.regexp_replace(c, f"[^0-9{COST_LETTERS}]+", "")
    total = F.length(symbols)
    for digit in "023456789":
        found = F.length(symbols) - F.length(F.replace(symbols, F.lit(digit), F.lit("")))
        total = total + found * (int(digit) - 1)
    return F.coalesce(total, F.lit(0)).cast("int")


def prefix_int(c: Column) -> Column:
    """Leading integer of a string (``1+*`` is 1), null when there is none."""
    return F.regexp_extract(c, rf"^{BLANK}*([+-]?[0-9]+)", 1).try_cast("int")


NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def to_cents(c: Column) -> Column:
    """Money text in hundredths, unrounded; null stays null, as does anything but a finite number.

    A cast alone would take type suffixes (``1.5d``) for numbers.
    """
    value = F.when(c.rlike(NUMBER), c.try_cast("double"))
    finite = F.abs(value) < float("inf")  # False for infinity, and NaN sorts above it
    return F.when(finite, value * 100)


def flag_map(m: Column, wanted="legal") -> Column:
    """Map to booleans: true only where the value is the wanted one; null is an empty map."""
    empty = F.create_map().cast("map<string,string>")
    return F.transform_values(F.coalesce(m, empty), lambda _, v: v.eqNullSafe(F.lit(wanted)))


def spread_flags(m: Column, keys=FORMATS) -> list:
    """One 0/1 column per key; a missing key is 0."""
    return [F.coalesce(m[k], F.lit(False)).cast("int").alias(k) for k in keys]


# -- keys and codes -----------------------------------------------------------------------------


def clean_name(c: Column) -> Column:
    """Lower-case, without anything but letters, digits, ``-``, ``_`` and single spaces.

    Other blanks become spaces first; then the characters to drop are named as ranges, which the
    regex engine tests many times faster than the negated list of those to keep.
    """
    odd = BLANKS.replace(" ", "")
    spaced = F.translate(F.lower(trim(c)), odd, " " * len(odd))
    kept = F.regexp_replace(spaced, DROPPED, "")
    return F.regexp_replace(kept, " {2,}", " ")


def name_key(c: Column) -> Column:
    return F.md5(clean_name(c))


def code_map(codes: dict) -> Column:
    """A code list as a map literal."""
    return F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])


def map_code(c: Column, codes: dict) -> Column:
    """Code of a value, null when unknown."""
    return code_map(codes)[c]


def uuid_hex(c: Column) -> Column:
    """UUID text as upper-case hex without dashes."""
    return F.upper(F.replace(c, F.lit("-"), F.lit("")))


def surrogate_id(*cols) -> Column:
    """Hex id derived from the row's own key, so that a retried task makes the same id."""
    return F.upper(F.md5(F.concat_ws("|", *[F.col(c) if isinstance(c, str) else c for c in cols])))


def date_digits(c: Column) -> Column:
    """Date text without dashes."""
    return F.replace(c, F.lit("-"), F.lit(""))


def yyyymmdd(c: Column) -> Column:
    """Date text (yyyy-mm-dd) as an integer yyyymmdd, null when it is no date."""
    return F.when(c.rlike(DAY) & c.try_cast("date").isNotNull(), date_digits(c).try_cast("int"))


# -- addresses ----------------------------------------------------------------------------------


def object_key(card_id: Column, name: Column) -> Column:
    """Key of an uploaded picture in the object store."""
    return F.concat(F.lit("cards/"), card_id, F.lit("-"), name)


def image_name(stem: Column, side) -> Column:
    """``<stem>-<side>.png``; the stem is a printing id at the source, a date at the target."""
    return F.concat(stem, F.lit("-"), side if isinstance(side, Column) else F.lit(side), F.lit(".png"))


def media_urls(base: str, card_id: Column, date: Column, back: Column, art: Column) -> dict:
    """Public addresses of a card's pictures; no back or art, no address."""
    root = F.lit(base.rstrip("/") + "/")
    day = date_digits(date)
    return {
        "front": F.concat(root, card_id, F.lit("-"), image_name(day, "front")),
        "back": F.when(back.isNotNull(), F.concat(root, card_id, F.lit("-"), image_name(day, "back"))),
        "art": F.when(art.isNotNull(), F.concat(root, F.upper(card_id), F.lit("-art.png"))),
    }


# -- documents ----------------------------------------------------------------------------------


def to_json_doc(*cols) -> Column:
    return F.to_json(F.struct(*cols))


def from_json_doc(c: Column, schema) -> Column:
    """Parse a JSON document; a malformed one fails the job instead of turning into nulls."""
    return F.from_json(c, schema, {"mode": "FAILFAST"})
