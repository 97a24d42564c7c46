"""Column functions and single-table operators on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import names, positions, text
from touchline.functions.keys import surrogate_key as key
from touchline.functions.similarity import jaro_winkler
from touchline.operators.latest import first_per_group
from touchline.operators.quality import (
    duplicates,
    is_missing,
    is_not_accepted,
    is_out_of_range,
    is_ratio_above,
    orphan_rows,
)
from touchline.plans.staging import stage_fbref
from touchline.schemas import FBREF_STATS, record_schema, with_metadata
from touchline.sources.records import with_reject_reason
from workload import oracle
from workload.league import read
from workload.registry import query


@query(f"SELECT c_custkey, {oracle.key('c_custkey', 'c_nationkey', 'c_mktsegment')} AS key FROM customer")
def surrogate_key(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey", key("c_custkey", "c_nationkey", "c_mktsegment").alias("key")
    )


@query(
    """SELECT doc_id, md5(trim(lower(strip_accents(text)))) AS name_md5,
  length(trim(lower(strip_accents(text)))) AS n_chars FROM documents"""
)
def normalize_names(spark, sf_dir):
    name = names.normalize_player_name(F.col("text"))
    return read(spark, sf_dir, "documents").select(
        "doc_id", F.md5(name).alias("name_md5"), F.char_length(name).alias("n_chars")
    )


_ASCII_SQL = "translate(strip_accents(lower(text)), 'øłđðħıĸŧſƀƒɨƶə‘’‚“”–‐‑ ', 'olddhiktsbfize'''',\"\"--- ')"
for _letter, _spelling in {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ĳ": "ij", "ŋ": "ng", "ŉ": "''n", "—": "--",
}.items():
    _ASCII_SQL = f"replace({_ASCII_SQL}, '{_letter}', '{_spelling}')"
_ASCII_SQL = rf"trim(regexp_replace({_ASCII_SQL}, '[ \t\n\v\f\r]+', ' ', 'g'))"


@query(f"SELECT doc_id, md5({_ASCII_SQL}) AS name_md5 FROM documents")
def ascii_names(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(
        "doc_id", F.md5(names.ascii_name(F.col("text"))).alias("name_md5")
    )


@query(
    r"""SELECT s_suppkey, trim(regexp_replace(regexp_replace(name,
    '^(1\.\s*fc|fc|cf|sc|ac|as|ss|ssc|us|rc|rcd|ca|cd|afc)[\s.]', ''), '\s+(fc|cf|sc|ac)$', ''))
  AS team_name
FROM (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'fc ' WHEN 1 THEN '1. fc ' WHEN 2 THEN 'rcd '
    WHEN 3 THEN 'ac.' ELSE '' END || lower(s_name)
    || CASE s_suppkey % 3 WHEN 0 THEN ' cf' WHEN 1 THEN '  fc' ELSE '' END AS name FROM supplier)"""
)
def club_affixes(spark, sf_dir):
    k = F.col("s_suppkey")
    prefix = (
        F.when(k % 5 == 0, "FC ").when(k % 5 == 1, "1. FC ").when(k % 5 == 2, "RCD ")
        .when(k % 5 == 3, "AC.").otherwise("")
    )
    suffix = F.when(k % 3 == 0, " CF").when(k % 3 == 1, "  FC").otherwise("")
    name = F.concat(prefix, F.col("s_name"), suffix)
    return read(spark, sf_dir, "supplier").select(
        "s_suppkey", names.ascii_team_name(name).alias("team_name")
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE trunc(l_extendedprice)::INT END AS price,
  CASE WHEN l_linenumber = 6 THEN NULL ELSE trunc(l_quantity)::INT END AS quantity,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE l_discount END AS discount,
  l_tax + 1234 AS tax FROM lineitem"""
)
def typed_cast(spark, sf_dir):
    line = F.col("l_linenumber")
    whole = F.floor("l_extendedprice")
    thousands = F.concat(
        F.floor(whole / 1000).cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0")
    )
    price = F.when(line == 7, "n/a").otherwise(thousands)
    quantity = F.when(line == 6, "").otherwise(F.col("l_quantity").cast("string"))
    # What only looks like a number to a cast is none.
    suffixed = F.element_at(F.array(*map(F.lit, ("-", "1d", "2.5f", "0x1p3"))), F.col("l_partkey").cast("int") % 4 + 1)
    discount = F.when(line == 5, suffixed).otherwise(F.col("l_discount").cast("string"))
    tax = F.concat(F.lit("1,234"), F.substring(F.col("l_tax").cast("string"), 2, 9))
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        text.grouped_int(price).alias("price"),
        text.whole_number(quantity).alias("quantity"),
        text.decimal_number(discount).alias("discount"),
        text.grouped_double(tax).alias("tax"),
    )


@query(
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN trunc(p_retailprice * 1000000)::BIGINT
  WHEN 1 THEN trunc(p_retailprice * 1000)::BIGINT WHEN 2 THEN trunc(p_retailprice)::BIGINT * 1000
  WHEN 3 THEN trunc(p_retailprice * 1000000000)::BIGINT ELSE NULL END AS market_value FROM part"""
)
def money_text(spark, sf_dir):
    k, price = F.col("p_partkey"), F.col("p_retailprice")
    amount = F.format_string("%.2f", price)
    written = (
        F.when(k % 6 == 0, F.concat(F.lit("€"), amount, F.lit("M")))
        .when(k % 6 == 1, F.concat(F.lit("€"), amount, F.lit(" k")))
        .when(k % 6 == 2, F.concat(F.lit("€"), F.floor(price).cast("string"), F.lit("Th.")))
        .when(k % 6 == 3, F.concat(F.lit("around €"), amount, F.lit("bn")))
        .when(k % 6 == 4, "-")
    )
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.market_value(written).alias("market_value")
    )


@query(
    f"""SELECT p_partkey, position_group, group_score, role_score, round(score, 6) AS score,
  CASE WHEN score >= 0.9::DOUBLE THEN 'auto_matched' ELSE 'review_needed' END AS band
FROM (SELECT *, 0.6::DOUBLE * (p_size / 50::DOUBLE) + 0.3::DOUBLE + 0.1::DOUBLE * group_score AS score
  FROM (SELECT *, {oracle._position_points('code', 'position_group', oracle._GROUPS)} AS group_score,
    {oracle._position_points('code', 'role', oracle._ROLES)} AS role_score
    FROM (SELECT p_partkey, p_size,
      CASE p_partkey % 5 WHEN 0 THEN 'Forward' WHEN 1 THEN 'Midfielder' WHEN 2 THEN 'Goalkeeper'
        WHEN 3 THEN 'Substitute' ELSE 'W ' || p_type END AS position_group,
      CASE p_size % 4 WHEN 0 THEN 'FW,MF' WHEN 1 THEN 'GK' WHEN 2 THEN NULL ELSE 'DF' END AS code,
      CASE p_partkey % 4 WHEN 0 THEN 'Second Striker' WHEN 1 THEN 'Left Midfield'
        WHEN 2 THEN 'Right-Back' ELSE 'Goalkeeper' END AS role FROM part)))"""
)
def position_band(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    raw = (
        F.when(k % 5 == 0, "F S").when(k % 5 == 1, "M").when(k % 5 == 2, "GK S")
        .when(k % 5 == 3, "Sub").otherwise(F.concat(F.lit("W "), "p_type"))
    )
    code = F.when(size % 4 == 0, "FW,MF").when(size % 4 == 1, "GK").when(size % 4 == 3, "DF")
    role = (
        F.when(k % 4 == 0, "Second Striker").when(k % 4 == 1, "Left Midfield")
        .when(k % 4 == 2, "Right-Back").otherwise("Goalkeeper")
    )
    group = positions.position_group(raw)
    by_group = positions.group_compatibility(code, group)
    score = positions.composite_score(size / 50.0, positions.team_overlap(k), by_group)
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        group.alias("position_group"),
        by_group.alias("group_score"),
        positions.role_compatibility(code, role).alias("role_score"),
        F.round(score, 6).alias("score"),
        positions.match_band(score).alias("band"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 OR o_orderkey % 8 = 0 THEN NULL
  ELSE (18 + o_orderkey % 20)::INT END AS age_years FROM orders"""
)
def age_years(spark, sf_dir):
    k = F.col("o_orderkey")
    age = F.when(k % 9 == 0, "25").when(
        k % 8 != 0, F.concat(18 + k % 20, F.lit("-"), F.format_string("%03d", k % 365))
    )
    return read(spark, sf_dir, "orders").select("o_orderkey", text.age_years(age).alias("age_years"))


@query(
    """SELECT year(o_orderdate)::VARCHAR AS start_year, count(*) AS n_orders FROM orders GROUP BY 1"""
)
def season_start(spark, sf_dir):
    year = F.year("o_orderdate")
    label = F.concat(year.cast("string"), F.lit("-"), (year + 1).cast("string"))
    return (
        read(spark, sf_dir, "orders")
        .groupBy(text.season_start_year(label).alias("start_year"))
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END
  AS born, CASE WHEN o_orderkey % 10 <> 0 THEN (o_custkey % 40)::INT END AS age FROM orders"""
)
def dob_parse(spark, sf_dir):
    k = F.col("o_orderkey")
    cell = F.concat(
        F.when(k % 10 == 0, "born ").otherwise(""),
        F.date_format("o_orderdate", "MMM d, yyyy"),
        F.lit(" ("), F.col("o_custkey") % 40, F.lit(")"),
    )
    born = text.birth_date_text(cell)
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(text.written_date(born), "yyyy-MM-dd").alias("born"),
        F.when(born.isNotNull(), text.age_in_parentheses(cell)).alias("age"),
    )


@query(
    """SELECT o_orderkey, o_orderstatus FROM orders
WHERE nullif(o_orderstatus, 'P') <> 'F'
  AND CASE WHEN o_custkey % 3 = 0 THEN TRUE ELSE o_custkey % 3 > 1 END"""
)
def stage_filter(spark, sf_dir):
    # Through staging: unknown flags drop a row, unknown minutes keep it.
    made = {
        "player_id": F.col("o_orderkey").cast("string"),
        "position": F.col("o_orderstatus"),
        "is_multi_team_total": F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F",
        "minutes": F.nullif(F.col("o_custkey") % 3, F.lit(0)) - 1,
    }
    raw = read(spark, sf_dir, "orders").select(*[
        made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in with_metadata(FBREF_STATS).fields
    ])
    return stage_fbref(raw).select(
        F.col("fbref_player_id").cast("long").alias("o_orderkey"), F.col("position").alias("o_orderstatus")
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL
  ELSE json_extract_string(props, '$.k')::INT END AS k FROM events WHERE event_id % 20 <> 7"""
)
def json_rows(spark, sf_dir):
    e = F.col("event_id")
    body = (
        F.when(e % 20 == 7, F.col("props"))  # an object and not a list gives no rows
        .when(e % 50 == 0, '[{"k": "x"}]')
        .otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    )
    events = read(spark, sf_dir, "events")
    # Elements that are no objects are no rows.
    objects = events.select("event_id", F.explode(text.json_objects(F.concat(F.lit(" \n"), body))).alias("o"))
    return objects.filter("o is not null").select(
        "event_id", text.whole_number(F.col("o")["k"]).alias("k")
    )


@query("SELECT event_id, event_type || ' é ' || props AS decoded FROM events")
def hex_decode(spark, sf_dir):
    escaped = F.concat(
        text.encode_hex_escapes(F.col("event_type")), F.lit(r" \xE9 "),
        text.encode_hex_escapes(F.col("props")),
    )
    return read(spark, sf_dir, "events").select(
        "event_id", text.decode_hex_escapes(escaped).alias("decoded")
    )


@query("SELECT * FROM (SELECT user_id, event_id, event_type, value FROM events) "
       "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def latest_row(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return first_per_group(
        events, ["user_id"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]
    ).drop("ts")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_extendedprice DESC NULLS LAST, l_linenumber, l_partkey) = 1"""
)
def top_value_row(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return first_per_group(
        lines, ["l_orderkey"],
        [F.col("l_extendedprice").desc_nulls_last(), F.col("l_linenumber").asc(),
         F.col("l_partkey").asc()],
    )


@query("SELECT p_brand, min(p_name) AS display_name FROM part GROUP BY 1")
def display_name(spark, sf_dir):
    spellings = read(spark, sf_dir, "part").select("p_brand", "p_name").distinct()
    return first_per_group(spellings, ["p_brand"], [F.col("p_name").asc_nulls_last()]).select(
        "p_brand", F.col("p_name").alias("display_name")
    )


@query(
    """SELECT p_name, c_name, round(jaro_winkler_similarity(p_name || ' of ' || c_mktsegment,
  c_mktsegment || ' ' || c_name), 6) AS similarity
FROM (SELECT DISTINCT p_name, c_name, c_mktsegment FROM lineitem
  JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey)"""
)
def similarity(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey")
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")
    )
    buyers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    pairs = (
        lines.join(parts, "l_partkey").join(orders, "l_orderkey").join(buyers, "c_custkey")
        .select("p_name", "c_name", "c_mktsegment").distinct()
    )
    left = F.concat("p_name", F.lit(" of "), "c_mktsegment")
    right = F.concat("c_mktsegment", F.lit(" "), "c_name")
    return pairs.select("p_name", "c_name", F.round(jaro_winkler(left, right), 6).alias("similarity"))


@query(
    f"""SELECT c_mktsegment, count(*) AS n_customers, {oracle.key('c_mktsegment')} AS segment_key
FROM customer GROUP BY 1"""
)
def dim_segment(spark, sf_dir):
    return (
        read(spark, sf_dir, "customer").groupBy("c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n_customers"))
        .withColumn("segment_key", key("c_mktsegment"))
    )


# --- data tests on the given tables ----------------------------------------------------------


@query("SELECT o_orderkey FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NULL")
def dq_not_null(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn(
        "priority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    )
    return orders.filter(is_missing("priority")).select("o_orderkey")


@query("SELECT l_partkey, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return duplicates(read(spark, sf_dir, "lineitem"), "l_partkey")


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def dq_accepted_values(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return events.filter(is_not_accepted("event_type", ["click", "view"])).select(
        "event_id", "event_type"
    )


@query(
    """SELECT c_custkey, c_acctbal FROM customer
WHERE (c_acctbal < 0 OR c_acctbal > 9000) AND c_nationkey > 3"""
)
def dq_accepted_range(spark, sf_dir):
    bad = is_out_of_range("c_acctbal", min_value=0, max_value=9000, where="c_nationkey > 3")
    return read(spark, sf_dir, "customer").filter(bad).select("c_custkey", "c_acctbal")


@query(
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL
AND o_custkey NOT IN (SELECT CASE WHEN c_acctbal > 1000 THEN c_custkey ELSE -c_custkey END FROM customer)"""
)
def dq_relationships(spark, sf_dir):
    # Customers with little money are known by another number.
    known = F.when(F.col("c_acctbal") > 1000, F.col("c_custkey")).otherwise(-F.col("c_custkey"))
    parents = read(spark, sf_dir, "customer").select(known.alias("c_custkey"))
    orders = read(spark, sf_dir, "orders")
    return orphan_rows(orders, "o_custkey", parents, "c_custkey").select("o_orderkey", "o_custkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_quantity - 3 > 0 AND l_tax * 100 / (l_quantity - 3) > 1"""
)
def dq_ratio(spark, sf_dir):
    lines = (
        read(spark, sf_dir, "lineitem")
        .withColumn("shots", F.col("l_quantity") - 3)
        .withColumn("xg", F.col("l_tax") * 100)
    )
    return lines.filter(is_ratio_above("xg", "shots")).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query(
    """SELECT coalesce(reason, 'valid') AS reason, count(*) AS n_records FROM (
  SELECT CASE WHEN lang = 'de' AND n_chars < 500 THEN 'missing source, text'
    WHEN lang = 'de' THEN 'missing source' WHEN n_chars < 500 THEN 'missing text' END AS reason
  FROM documents) GROUP BY 1"""
)
def reject_split(spark, sf_dir):
    schema = record_schema("doc_id bigint, source string, text string", "doc_id source text")
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("lang") != "de", F.col("source")).alias("source"),
        F.when(F.col("n_chars") >= 500, F.col("text")).alias("text"),
    )
    return (
        with_reject_reason(docs, schema)
        .groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("reason"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
