"""Predicates, scalar rules and generators."""

from pyspark.sql import functions as F

from printfold.functions import predicates as P
from printfold.functions import scalars as S
from printfold.operators.children import explode_child
from printfold.operators.flatten import manifest_rows
from printfold.operators.fold import SLOTS, count_valid
from printfold.queries.registry import query
from printfold.schema import COLORS, IMAGE_SIZES, RARITIES, TWO_SIDED_LAYOUTS
from printfold.sources.images import image_parts
from printfold.sources.manifest import LINE, manifest_line, parse_delimited

# The blanks in SQL's own notation.
SQL_BLANKS = "'" + S.BLANKS + "'"
SQL_BLANK = (
    r"\s\x0B\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
)


# -- predicates ---------------------------------------------------------------------------------

VALID_TEXT = r"the{blank}ands?"
VALID_SQL = rf"""
    lower(lang) = 'en'
    AND NOT regexp_matches(text, 'the[{SQL_BLANK}]ands?', 'i')
    AND trim(split_part(source, '1', 1), {SQL_BLANKS}) NOT IN ('src3', 'src7')"""


def _valid(documents):
    return documents.where(
        P.lang_is(F.col("lang"), "en")
        & P.name_not_like(F.col("text"), VALID_TEXT)
        & P.type_head_not_in(F.col("source"), ["src3", "src7"], sep="1")
    )


@query(f"SELECT doc_id, source, md5(text) AS text_key FROM documents WHERE {VALID_SQL}")
def q_filter_valid(t):
    """English documents, by whole text and by the head of their source."""
    return _valid(t.documents).select("doc_id", "source", F.md5("text").alias("text_key"))


@query(f"SELECT count(*) AS valid FROM documents WHERE {VALID_SQL}")
def q_count_valid(t):
    return count_valid(_valid(t.documents))


@query(
    """SELECT count(*) AS valid FROM part
       WHERE NOT regexp_matches(p_name, 'World[[:space:]]Championships?[[:space:]]Ad', 'i')
         AND trim(p_type) <> 'Card'"""
)
def q_is_valid(t):
    """The catalogue's own three tests, on parts taken as English printings."""
    printings = t.part.select(
        F.lit("EN").alias("lang"), F.col("p_name").alias("name"), F.col("p_type").alias("type_line")
    )
    return count_valid(printings.where(P.is_valid()))


@query(
    """SELECT d.doc_id, l.quality FROM documents d JOIN labels l USING (doc_id)
       WHERE d.text <> '' AND l.toxic = 0"""
)
def q_has_value(t):
    """Documents with text and with a harmless label: no label is null, a toxic one empty."""
    verdict = F.when(F.col("toxic") == 1, "").otherwise("harmless").alias("front")
    labels = t.labels.select("doc_id", "quality", verdict)
    both = t.documents.join(labels, "doc_id", "left")
    return both.where(P.has_front() & P.has_value(F.col("text"))).select("doc_id", "quality")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def q_require_not_null(t):
    """The check passes every row of a table without nulls."""
    checked = P.require_not_null(F.col("o_orderstatus"), "o_orderstatus")
    return t.orders.select("o_orderkey", checked.alias("o_orderstatus"))


# -- choosing among values ----------------------------------------------------------------------


@query(
    """SELECT event_id,
              CASE WHEN event_type = 'view' AND value >= 20 THEN 'large' || event_id
                   WHEN event_type = 'click' THEN 'small' || event_id
                   ELSE json_extract_string(props, '$.k') END AS image,
              CASE WHEN event_type = 'error' THEN 'crop' || event_id END AS art
       FROM events"""
)
def q_pick_first(t):
    """Best picture by size, else the map's first entry; and the art crop."""
    text = F.col("event_id").cast("string")
    kind = F.col("event_type")
    large = F.when(F.col("value") >= 20, F.concat(F.lit("large"), text)).otherwise("")
    sizes = F.map_concat(
        F.from_json("props", "map<string,string>"),
        F.create_map(
            F.when(kind == "view", "large").when(kind == "click", "small")
            .when(kind == "error", "art_crop").otherwise("other"),
            F.when(kind == "view", large).when(kind == "click", F.concat(F.lit("small"), text))
            .otherwise(F.concat(F.lit("crop"), text)),
        ),
    )
    maps = t.events.select("event_id", sizes.alias("m"))
    return maps.select(
        "event_id",
        S.pick_first(F.col("m"), IMAGE_SIZES).alias("image"),
        S.art_crop(F.col("m")).alias("art"),
    )


@query(
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'P' THEN 'none'
                   WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE o_orderstatus END AS first_item,
              CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS items
       FROM orders"""
)
def q_first_list(t):
    """First list that is not null, where an empty one counts."""
    status = F.col("o_orderstatus")
    empty = F.array().cast("array<string>")
    own = F.when(status == "P", empty).when(status == "F", F.array(status, "o_orderpriority"))
    rows = t.orders.select("o_orderkey", S.first_list(own, F.array("o_orderpriority")).alias("l"))
    return rows.select(
        "o_orderkey",
        F.coalesce(F.get("l", F.lit(0)), F.lit("none")).alias("first_item"),
        F.size("l").alias("items"),
    )


@query(
    """SELECT o_orderkey,
              CASE o_orderstatus WHEN 'F' THEN 'f0' || o_custkey ELSE 'top' || o_orderkey END AS front,
              CASE o_orderstatus WHEN 'F' THEN 'f1' || o_custkey
                                 WHEN 'O' THEN 'top' || o_orderkey END AS back,
              CASE o_orderstatus WHEN 'F' THEN 'art' || o_custkey END AS art
       FROM orders"""
)
def q_case_media(t):
    """Front, back and art by layout: two-sided, faced, plain."""
    status = F.col("o_orderstatus")

    def face(size, prefix):
        url = F.concat(F.lit(prefix), F.col("o_custkey").cast("string"))
        art = F.concat(F.lit("art"), F.col("o_custkey").cast("string"))
        uris = F.create_map(F.lit(size), url, F.lit("art_crop"), art)
        return F.struct(uris.alias("image_uris"))

    rows = t.orders.select(
        "o_orderkey",
        F.when(status == "F", "transform").when(status == "O", "split").otherwise("normal")
        .alias("layout"),
        F.when(status != "P", F.array(face("png", "f0"), face("small", "f1"))).alias("faces"),
        F.create_map(
            F.lit("normal"), F.concat(F.lit("top"), F.col("o_orderkey").cast("string"))
        ).alias("images"),
    )
    media = S.media_columns(F.col("layout"), F.col("faces"), F.col("images"), TWO_SIDED_LAYOUTS)
    return rows.select("o_orderkey", *[c.alias(n) for n, c in media.items()])


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
              coalesce(nullif(l_discount, 0), nullif(l_tax, 0), 100) AS price,
              coalesce(nullif(l_linenumber, 1), 99999) AS rank,
              nullif(l_returnflag, 'N') AS flag
       FROM lineitem"""
)
def q_price_default(t):
    """Null or zero gives way to the next price, then to the default."""
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        S.final_price(F.col("l_discount"), F.col("l_tax")).alias("price"),
        S.final_rank(S.truthy(F.col("l_linenumber"), 1)).alias("rank"),
        S.truthy(F.col("l_returnflag"), "N").alias("flag"),
    )


# -- faces --------------------------------------------------------------------------------------


@query(
    r"""WITH lines AS (
          SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS l FROM documents)
        SELECT doc_id, CAST(len(l) AS INTEGER) AS texts,
               md5(array_to_string(l, chr(10))) AS text_key FROM lines"""
)
def q_face_texts(t):
    """A document's lines as faces: their non-empty texts in order."""
    faces = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("oracle_text")))
    texts = S.collect_faces(F.col("faces"), F.lit(None).cast("string"), "oracle_text")
    rows = t.documents.select("doc_id", faces.alias("faces")).select("doc_id", texts.alias("texts"))
    return rows.select(
        "doc_id", F.size("texts").alias("texts"), F.md5(F.array_join("texts", "\n")).alias("text_key")
    )


@query(
    """SELECT doc_id, CAST(text <> '' AS INTEGER) AS texts, md5(text) AS text_key FROM documents"""
)
def q_top_texts(t):
    """Documents without faces: the text itself, as a list of none or one."""
    faces = F.lit(None).cast("array<struct<oracle_text:string>>")
    texts = S.collect_faces(faces, F.col("text"), "oracle_text")
    rows = t.documents.select("doc_id", texts.alias("texts"))
    return rows.select(
        "doc_id", F.size("texts").alias("texts"), F.md5(F.array_join("texts", "\n")).alias("text_key")
    )


@query(
    f"""SELECT doc_id, trim(split_part(text, '.', 1), {SQL_BLANKS}) AS head,
              CAST(len(string_split(text, '.')) - 1 AS INTEGER) AS pieces,
              md5(array_to_string(list_transform(string_split(text, '.')[2:],
                  lambda x: trim(x, {SQL_BLANKS})), '/')) AS tail_key
       FROM documents"""
)
def q_type_split(t):
    """Head and trimmed later pieces of the whole text, cut at full stops."""
    tail = S.type_tail(F.col("text"), ".")
    return t.documents.select(
        "doc_id",
        S.type_head(F.col("text"), ".").alias("head"),
        F.size(tail).alias("pieces"),
        F.md5(F.array_join(tail, "/")).alias("tail_key"),
    )


@query(
    """SELECT p_partkey,
              CASE WHEN p_type = 'PROMO' THEN split_part(p_name, ' ', 1) ELSE p_type END AS head,
              array_to_string(list_concat(CASE WHEN p_type = 'PROMO' THEN [] ELSE [p_brand] END,
                                          string_split(p_name, ' ')[2:]), '/') AS tail
       FROM part"""
)
def q_face_types(t):
    """Type over two faces: the first non-empty head, and all tails one after the other."""
    first = F.when(F.col("p_type") == "PROMO", " ").otherwise(F.concat_ws(" ", "p_type", "p_brand"))
    blank_first = F.when(F.col("p_type") != "PROMO", first)
    faces = F.array(
        F.struct(blank_first.alias("type_line")),
        F.struct(F.col("p_name").alias("type_line")),
    )
    rows = t.part.select("p_partkey", faces.alias("faces"))
    return rows.select(
        "p_partkey",
        S.face_type_head(F.col("faces"), " ").alias("head"),
        F.array_join(S.face_type_tail(F.col("faces"), " "), "/").alias("tail"),
    )


@query(
    """SELECT p_partkey,
              CASE WHEN p_type = 'PROMO' THEN cast(p_size AS VARCHAR)
                   WHEN p_type = 'SMALL' THEN '0'
                   WHEN p_size > 25 THEN NULL ELSE p_brand END AS power,
              CASE WHEN p_type = 'PROMO' THEN p_name
                   WHEN p_type = 'SMALL' THEN '0' ELSE p_type END AS toughness
       FROM part"""
)
def q_any_then_first(t):
    """Stats: face 0's when any face has both; the top-level pair for parts without faces."""

    def face(power, toughness):
        return F.struct(power.alias("power"), toughness.alias("toughness"))

    small = F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_name"))
    faces = F.when(
        F.col("p_type") != "PROMO",
        F.array(
            face(F.when(F.col("p_size") <= 25, F.col("p_brand")),
                 F.when(F.col("p_type") != "SMALL", F.col("p_type"))),
            face(F.col("p_size").cast("string"), small),
        ),
    )
    rows = t.part.select("p_partkey", "p_size", "p_name", faces.alias("faces"))
    stats = S.stats_columns(F.col("faces"), F.col("p_size").cast("string"), F.col("p_name"))
    return rows.select("p_partkey", *[c.alias(n) for n, c in stats.items()])


# -- numbers ------------------------------------------------------------------------------------


@query(
    """SELECT doc_id, CAST(coalesce(list_sum(list_transform(
              regexp_extract_all(text, '[0-9RUBGWS]'),
              lambda x: coalesce(try_cast(x AS INTEGER), 1))), 0) AS INTEGER) AS cost
       FROM documents"""
)
def q_cost_value(t):
    """Cost symbols over the whole text."""
    return t.documents.select("doc_id", S.cost_value(F.col("text")).alias("cost"))


@query(
    r"""SELECT c_custkey,
               try_cast(nullif(regexp_extract(CASE c_mktsegment WHEN 'BUILDING' THEN '  +' || abs(c_acctbal)
                    WHEN 'MACHINERY' THEN '*' || c_acctbal ELSE c_acctbal || '+*' END,
                    '^\s*([+-]?[0-9]+)', 1), '') AS INTEGER) AS prefix
        FROM customer"""
)
def q_prefix_int(t):
    """Leading integer of balances, some with blanks and a sign, some with a star in front."""
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    text = (
        F.when(segment == "BUILDING", F.concat(F.lit("  +"), F.abs(balance).cast("string")))
        .when(segment == "MACHINERY", F.concat(F.lit("*"), balance.cast("string")))
        .otherwise(F.concat(balance.cast("string"), F.lit("+*")))
    )
    return t.customer.select("c_custkey", S.prefix_int(text).alias("prefix"))


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value * 100 END AS cents
       FROM events"""
)
def q_cents(t):
    """Money text to hundredths; text that is no number is null."""
    odd = F.array(*map(F.lit, ("n/a", "1.5d", "2f", "1,5", "")))
    odd = F.get(odd, (F.col("event_id") % 5).cast("int"))
    text = F.when(F.col("event_type") == "error", odd).otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", S.to_cents(text).alias("cents"))


@query(
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS standard,
              CAST(o_orderpriority = '5-LOW' AS INTEGER) AS modern, 0 AS legacy
       FROM orders"""
)
def q_flags(t):
    """A map of verdicts spread into 0/1 columns; only one verdict counts as yes."""
    verdicts = F.create_map(
        F.lit("standard"),
        F.when(F.col("o_orderstatus") == "F", "legal").when(F.col("o_orderstatus") == "O", "banned"),
        F.lit("modern"),
        F.when(F.col("o_orderpriority") == "5-LOW", "legal").otherwise("restricted"),
    )
    rows = t.orders.select("o_orderkey", S.flag_map(verdicts).alias("m"))
    return rows.select("o_orderkey", *S.spread_flags(F.col("m"), ("standard", "modern", "legacy")))


# -- keys and codes -----------------------------------------------------------------------------


@query(
    rf"""SELECT doc_id, md5(regexp_replace(regexp_replace(lower(trim(text, {SQL_BLANKS})),
               '[^a-z0-9\-_{SQL_BLANK}]', '', 'g'), '[{SQL_BLANK}]+', ' ', 'g')) AS name_key
        FROM documents"""
)
def q_name_key(t):
    """Key of the cleaned whole text."""
    return t.documents.select("doc_id", S.name_key(F.col("text")).alias("name_key"))


@query(
    """SELECT c.conv_id, c.turn, r.code FROM conversations c
       LEFT JOIN (VALUES ('user', 1), ('assistant', 2)) r(role, code) USING (role)"""
)
def q_code_lookup(t):
    """Role to code, unknown to null."""
    codes = {"user": 1, "assistant": 2}
    return t.conversations.select("conv_id", "turn", S.map_code(F.col("role"), codes).alias("code"))


@query(
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 4 WHEN 'LARGE' THEN 3 WHEN 'MEDIUM' THEN 2
              WHEN 'STANDARD' THEN 1 END AS rarity,
              CASE left(p_name, 1) WHEN 'r' THEN 4 WHEN 'b' THEN 3 END AS color
       FROM part"""
)
def q_card_codes(t):
    """The catalogue's own code lists."""
    kind = F.col("p_type")
    rarity = (
        F.when(kind == "PROMO", "mythic").when(kind == "LARGE", "rare")
        .when(kind == "MEDIUM", "uncommon").when(kind == "STANDARD", "common").otherwise("special")
    )
    letter = F.upper(F.left("p_name", F.lit(1)))
    color = F.when(letter.isin("R", "B"), letter).otherwise("none")
    return t.part.select(
        "p_partkey",
        S.map_code(rarity, RARITIES).alias("rarity"),
        S.map_code(color, COLORS).alias("color"),
    )


@query(
    """SELECT c_custkey, upper(md5(c_name)) AS hex,
              upper(md5('customer|' || c_custkey || '|' || c_name)) AS new_id
       FROM customer"""
)
def q_uuid_hex(t):
    """UUID text to hex, and an id made from the row's key."""
    digest = F.md5("c_name")
    dashed = F.concat_ws("-", F.left(digest, F.lit(8)), F.substring(digest, 9, 4),
                         F.substring(digest, 13, 4), F.substring(digest, 17, 16))
    return t.customer.select(
        "c_custkey",
        S.uuid_hex(dashed).alias("hex"),
        S.surrogate_id(F.lit("customer"), "c_custkey", "c_name").alias("new_id"),
    )


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
              THEN CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END AS day FROM orders"""
)
def q_yyyymmdd(t):
    """Dates as integers; text that is no date is null."""
    odd = F.array(*map(F.lit, ("soon", "2024-1", "12", "20-24", "2024-02-30")))
    odd = F.get(odd, (F.col("o_orderkey") % 5).cast("int"))
    text = F.when(F.col("o_orderstatus") == "P", odd).otherwise(_day("o_orderdate"))
    return t.orders.select("o_orderkey", S.yyyymmdd(text).alias("day"))


# -- addresses and documents --------------------------------------------------------------------

BASE = "https://pictures.example/cards"


@query(
    f"""WITH o AS (SELECT *, upper(md5('' || o_orderkey)) AS id, strftime(o_orderdate, '%Y%m%d') AS d
                   FROM orders)
        SELECT o_orderkey, '{BASE}/' || id || '-' || d || '-front.png' AS front,
               CASE WHEN o_orderstatus = 'F' THEN '{BASE}/' || id || '-' || d || '-back.png' END AS back,
               CASE WHEN o_orderstatus = 'O' THEN '{BASE}/' || id || '-art.png' END AS art,
               'cards/' || id || '-' || d || '-front.png' AS object_key
        FROM o"""
)
def q_build_url(t):
    """Public addresses and object keys."""
    rows = t.orders.select(
        "o_orderkey",
        F.upper(F.md5(F.col("o_orderkey").cast("string"))).alias("id"),
        _day("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") == "F", "b").alias("back"),
        F.when(F.col("o_orderstatus") == "O", "a").alias("art"),
    )
    urls = S.media_urls(BASE, F.col("id"), F.col("date"), F.col("back"), F.col("art"))
    target = S.object_key(F.col("id"), S.image_name(S.date_digits(F.col("date")), "front"))
    return rows.select(
        "o_orderkey", *[c.alias(n) for n, c in urls.items()], target.alias("object_key")
    )


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type, value
       FROM events"""
)
def q_from_json(t):
    """Parse documents, write them with more fields, and parse those."""
    parsed = t.events.withColumn("k", S.from_json_doc(F.col("props"), "k int")["k"])
    docs = parsed.select("event_id", S.to_json_doc("k", "event_type", "value").alias("doc"))
    back = S.from_json_doc(F.col("doc"), "k int, event_type string, value double")
    return docs.select("event_id", back.alias("d")).select("event_id", "d.*")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'old' ELSE 'new' END AS status,
              strftime(o_orderdate, '%Y-%m-%d') AS date, cast(o_orderkey AS VARCHAR) AS sid,
              lower(o_orderpriority) AS url
       FROM orders WHERE o_orderstatus <> 'P'"""
)
def q_parse_delimited(t):
    """Manifest lines written and split again; blank lines are skipped."""
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "old").otherwise("new").alias("status"),
        _day("o_orderdate").alias("date"),
        F.col("o_orderkey").cast("string").alias("sid"),
        F.lower("o_orderpriority").alias("url"),
        "o_orderstatus",
    )
    line = F.when(F.col("o_orderstatus") == "P", "").otherwise(manifest_line())
    return parse_delimited(rows.select("o_orderkey", line.alias("line")), "line", LINE)


@query(
    r"""SELECT page_id, list_last(string_split(url, '/')) AS oracle_id,
               CASE WHEN starts_with(url, 'https') THEN cast(page_id AS VARCHAR) END AS sid,
               CASE WHEN starts_with(url, 'https') THEN 'front' ELSE 'art' END AS side
        FROM pages WHERE list_last(string_split(url, '/')) <> ''"""
)
def q_url_parts(t):
    """Card, printing and side from picture paths below the page addresses."""
    own = F.when(
        F.col("url").startswith("https"), S.image_name(F.col("page_id").cast("string"), "front")
    ).otherwise("art.png")
    parts = image_parts(F.concat_ws("/", "url", own))
    rows = t.pages.select("page_id", *[c.alias(n) for n, c in parts.items()])
    return rows.where("oracle_id is not null")


# -- generators ---------------------------------------------------------------------------------

CHILD_SQL = """
    WITH p AS (SELECT upper(md5('' || p_partkey)) AS card_id, string_split(p_name, ' ') AS l FROM part),
         e AS (SELECT card_id, unnest(l) AS item, generate_subscripts(l, 1) - 1 AS pos FROM p)
    SELECT upper(md5('{table}|' || card_id || '|' || pos)) AS id, card_id, {value} FROM e"""


def _listed(t):
    return t.part.select(
        F.upper(F.md5(F.col("p_partkey").cast("string"))).alias("id"),
        F.split("p_name", " ").alias("items"),
    )


@query(CHILD_SQL.format(table="card_subtypes", value="item AS subtype"))
def q_explode(t):
    """List items to child rows with their own ids."""
    return explode_child(_listed(t), "items", "subtype", "card_subtypes")


@query(
    CHILD_SQL.format(
        table="card_colors",
        value="CASE item WHEN 'red' THEN 1 WHEN 'hot' THEN 2 WHEN 'ring' THEN 3 END AS color_id",
    )
)
def q_explode_codes(t):
    """List items to child rows with codes, unknown to null."""
    codes = {"red": 1, "hot": 2, "ring": 3}
    return explode_child(_listed(t), "items", "color_id", "card_colors", codes=codes)


@query(
    """SELECT doc_id, count(*) AS words, count(DISTINCT word) AS forms,
              max(upper(md5('words|' || doc_id || '|' || pos))) AS last_id
       FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
                    generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents)
       GROUP BY doc_id"""
)
def q_explode_text(t):
    """Whole texts to one row per word, summed up per document."""
    texts = t.documents.select("doc_id", F.split("text", " ").alias("words"))
    words = explode_child(texts, "words", "word", "words", "doc_id")
    # Tasks sum up the texts they read, whose words stay there; only documents of several texts send words on.
    summed = words.groupBy("card_id").agg(F.count(F.lit(1)).alias("words"), F.max("id").alias("last_id"))
    each = texts.groupBy("doc_id").agg(F.count("words").alias("_texts"), F.max(F.size(F.array_distinct("words"))).cast("long").alias("forms"))
    forms = each.where("_texts = 1").drop("_texts").unionByName(_shared_forms(texts, each.where("_texts > 1").select("doc_id")))
    same = F.col("card_id").eqNullSafe(F.col("doc_id"))
    return summed.join(forms, same).select("doc_id", "words", "forms", "last_id")


def _shared_forms(texts, several):
    """How many different words the texts of some documents have together.

    The documents are dealt to slots, a number of which every task is told first: texts of other slots stay where they are.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).alias("_slot")
    near = texts.select("*", slot).join(F.broadcast(several.select(slot).distinct()), "_slot")
    several = several.withColumnRenamed("doc_id", "_id").hint("shuffle_hash")
    shared = near.join(several, F.col("doc_id").eqNullSafe(F.col("_id")))  # a semi-join would be made before that of the slots
    forms = explode_child(shared, "words", "word", "words", "doc_id").select("card_id", "word").distinct()
    return forms.groupBy(F.col("card_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("forms"))


@query(
    """SELECT cast(o_custkey AS VARCHAR) AS oracle_id, cast(o_orderkey AS VARCHAR) AS sid,
              strftime(o_orderdate, '%Y-%m-%d') AS date, side, url
       FROM orders, LATERAL (VALUES ('front', CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END),
                                    ('back', CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END)) s(side, url)
       WHERE url <> ''"""
)
def q_sides(t):
    """One row per printing and side with a picture."""
    status = F.col("o_orderstatus")
    prints = t.orders.select(
        F.col("o_custkey").cast("string").alias("oracle_id"),
        F.col("o_orderkey").cast("string").alias("sid"),
        _day("o_orderdate").alias("date"),
        F.when(status != "P", F.col("o_orderpriority")).alias("front"),
        F.when(status == "F", "").otherwise(status).alias("back"),
    )
    return manifest_rows(prints)
