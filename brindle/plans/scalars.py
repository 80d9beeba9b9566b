
from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions.times import trunc
from brindle.functions.vectors import cosine, dot
from brindle.operators.joins import broadcast_below
from brindle.plans.query import Query, frame, sql

_VECTOR = """
WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0),
p AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(q.e)::DOUBLE AS y, generate_subscripts(embedding, 1) AS i FROM embeddings, q)
"""

#: crc32 bit by bit, and xxhash64 of a 64-bit number (seed 42) in arithmetic modulo 2**64: DuckDB has neither.
_CHECKSUMS = """
WITH m AS (SELECT 18446744073709551616::UHUGEINT AS m, 11400714785074694791::UHUGEINT AS p1, 14029467366897019727::UHUGEINT AS p2, 1609587929392839161::UHUGEINT AS p3, 9650029242287828579::UHUGEINT AS p4, 2870177450012600261::UHUGEINT AS p5),
a AS (SELECT p_partkey, p_name, p_partkey::UHUGEINT * p2 % m AS k, (42 + p5 + 8) % m AS h, m.* FROM part, m),
b AS (SELECT *, xor(h, (k * 2147483648 % m + k // 8589934592) * p1 % m) AS h1 FROM a),
c AS (SELECT *, ((h1 * 134217728 % m + h1 // 137438953472) * p1 + p4) % m AS h2 FROM b),
d AS (SELECT *, xor(h2, h2 // 8589934592) * p2 % m AS h3 FROM c),
e AS (SELECT *, xor(h3, h3 // 536870912) * p3 % m AS h4 FROM d),
f AS (SELECT *, xor(h4, h4 // 4294967296)::HUGEINT AS x FROM e)
SELECT p_partkey, xor(list_reduce(list_prepend(4294967295, list_transform(split(p_name, ''), lambda z: ascii(z)::BIGINT)), lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda y, i: xor(y >> 1, (y & 1) * 3988292384))), 4294967295)::BIGINT AS c,
       (CASE WHEN x >= 9223372036854775808 THEN x - 18446744073709551616 ELSE x END)::BIGINT AS x FROM f
"""

QUERIES: dict[str, Query] = {
    "f1_strings": sql(
        "SELECT p_partkey, upper(p_name) AS u, CAST(length(p_type) AS BIGINT) AS n, substr(p_brand, 1, 5) AS head, p_name || '/' || p_type AS both, split_part(p_name, ' ', 1) AS word, CAST(levenshtein(p_name, p_type) AS BIGINT) AS far, lpad(p_brand, 12, '*') AS padded, replace(p_type, 'A', 'a') AS swapped, reverse(p_name) AS back, trim(concat('  ', p_name, ' ')) AS trimmed, ltrim(' ' || p_name) AS l, repeat(substr(p_name, 1, 1), 3) AS r, translate(p_brand, 'Br', 'bR') AS t, CAST(instr(p_name, 'e') AS BIGINT) AS at, starts AS starts FROM (SELECT *, startswith(p_name, 'b') AS starts FROM {part})",
        "SELECT p_partkey, upper(p_name) AS u, length(p_type) AS n, substr(p_brand, 1, 5) AS head, p_name || '/' || p_type AS both, split_part(p_name, ' ', 1) AS word, levenshtein(p_name, p_type) AS far, lpad(p_brand, 12, '*') AS padded, replace(p_type, 'A', 'a') AS swapped, reverse(p_name) AS back, trim(concat('  ', p_name, ' ')) AS trimmed, ltrim(' ' || p_name) AS l, repeat(substr(p_name, 1, 1), 3) AS r, translate(p_brand, 'Br', 'bR') AS t, instr(p_name, 'e') AS at, starts_with(p_name, 'b') AS starts FROM {part}",
    ),
    "f1_regex": sql(
        "SELECT user_id, event_id, regexp_extract(props, '([0-9]+)', 1) AS digits, regexp_replace(props, '[0-9]', '#') AS masked, props RLIKE '5' AS five, CAST(regexp_count(props, '[0-9]') AS BIGINT) AS n FROM {events}",
        "SELECT user_id, event_id, regexp_extract(props, '([0-9]+)', 1) AS digits, regexp_replace(props, '[0-9]', '#', 'g') AS masked, regexp_matches(props, '5') AS five, len(regexp_extract_all(props, '[0-9]')) AS n FROM {events}",
    ),
    "f1_url": frame(lambda p: p.select("page_id", F.parse_url("url", F.lit("HOST")).alias("host")), "pages", "SELECT page_id, regexp_extract(url, '//([^/?#:]+)', 1) AS host FROM pages"),
    "f1_more": sql(
        "SELECT event_id, array_join(regexp_extract_all(props, '[0-9]', 0), '-') AS digits, event_type COLLATE UTF8_LCASE = upper(event_type) AS same, soundex('Miller') AS sound, CAST(char_length(event_type) AS BIGINT) AS n, initcap(event_type) AS cap FROM {events}",
        "SELECT event_id, array_to_string(regexp_extract_all(props, '[0-9]'), '-') AS digits, lower(event_type) = lower(upper(event_type)) AS same, 'M460' AS sound, length(event_type) AS n, upper(event_type[1]) || lower(event_type[2:]) AS cap FROM {events}",
    ),
    "f2_checksums": frame(lambda p: p.select("p_partkey", F.crc32("p_name").alias("c"), F.xxhash64("p_partkey").alias("x")), "part", _CHECKSUMS),
    "f2_hashes": sql("SELECT doc_id, md5(text) AS m, sha2(text, 256) AS s FROM {documents}", "SELECT doc_id, md5(text) AS m, sha256(text) AS s FROM {documents}"),
    "f2_crc32": frame(lambda d: d.select("doc_id", F.crc32("text").alias("c"), F.xxhash64("text").alias("x")), "documents", None),
    "f3_dates": frame(
        lambda o: o.select("o_orderkey", trunc("month", F.col("o_orderdate")).alias("m"), F.year("o_orderdate").cast("long").alias("y"), F.quarter("o_orderdate").cast("long").alias("q"), F.weekday("o_orderdate").cast("long").alias("wd"), F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("long").alias("days"), F.add_months(F.col("o_orderdate").cast("date"), 1).alias("next"), F.last_day(F.col("o_orderdate").cast("date")).alias("last"), F.date_format("o_orderdate", "yyyy/MM/dd").alias("text")),
        "orders",
        "SELECT o_orderkey, date_trunc('month', o_orderdate) AS m, year(o_orderdate) AS y, quarter(o_orderdate) AS q, isodow(o_orderdate) - 1 AS wd, datediff('day', DATE '1995-01-01', o_orderdate::DATE) AS days, (o_orderdate::DATE + INTERVAL 1 MONTH)::DATE AS next, last_day(o_orderdate::DATE) AS last, strftime(o_orderdate, '%Y/%m/%d') AS text FROM orders",
    ),
    "f3_intervals": sql("SELECT event_id, ts + INTERVAL '90' MINUTE AS later, CAST(timestampdiff(HOUR, TIMESTAMP_NTZ '2024-01-01', ts) AS BIGINT) AS hours FROM {events}", "SELECT event_id, ts + INTERVAL 90 MINUTE AS later, datesub('hour', TIMESTAMP '2024-01-01', ts) AS hours FROM {events}"),
    "f3_calendar": sql(
        "SELECT o_orderkey, round(months_between(CAST(o_orderdate AS DATE), DATE '1995-01-01'), 6) AS months, CAST(extract(DOY FROM o_orderdate) AS BIGINT) AS doy, CAST(extract(WEEK FROM o_orderdate) AS BIGINT) AS week, date_add(CAST(o_orderdate AS DATE), 10) AS later, next_day(CAST(o_orderdate AS DATE), 'MON') AS monday FROM {orders}",
        "SELECT o_orderkey, round((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 + (day(o_orderdate) - 1) / 31.0, 6)::DOUBLE AS months, dayofyear(o_orderdate) AS doy, weekofyear(o_orderdate) AS week, (o_orderdate::DATE + INTERVAL 10 DAY)::DATE AS later, (o_orderdate::DATE + (8 - isodow(o_orderdate))::INTEGER) AS monday FROM {orders}",
    ),
    "f4_rounding": sql("SELECT l_orderkey, l_linenumber, pmod(l_partkey - 1000, 7) AS p, CAST(bround(l_quantity / 2, 0) AS BIGINT) AS even, shiftleft(l_partkey, 2) AS s, l_partkey & 12 AS a, hex(l_linenumber) AS h FROM {lineitem}", "SELECT l_orderkey, l_linenumber, ((l_partkey - 1000) % 7 + 7) % 7 AS p, CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS even, l_partkey << 2 AS s, l_partkey & 12 AS a, upper(to_hex(l_linenumber)) AS h FROM {lineitem}"),
    "f4_math": sql(
        "SELECT l_orderkey, l_linenumber, l_partkey DIV 7 AS d, l_partkey % 7 AS m, CAST(round(l_extendedprice, 0) AS BIGINT) AS r, CAST(ceil(l_discount * 10) AS BIGINT) AS c, CAST(floor(l_tax * 100) AS BIGINT) AS f, round(sqrt(l_quantity), 9) AS sq, abs(l_quantity - 25) AS a, sign(l_quantity - 25) AS sg, greatest(l_discount, l_tax) AS g, least(l_discount, l_tax) AS l, round(ln(l_quantity + 1), 9) AS ln, round(power(l_quantity, 2), 3) AS p, try_divide(l_quantity, l_discount) AS q FROM {lineitem}",
        "SELECT l_orderkey, l_linenumber, l_partkey // 7 AS d, l_partkey % 7 AS m, CAST(round(l_extendedprice, 0) AS BIGINT) AS r, CAST(ceil(l_discount * 10) AS BIGINT) AS c, CAST(floor(l_tax * 100) AS BIGINT) AS f, round(sqrt(l_quantity), 9) AS sq, abs(l_quantity - 25) AS a, CAST(sign(l_quantity - 25) AS DOUBLE) AS sg, greatest(l_discount, l_tax) AS g, least(l_discount, l_tax) AS l, round(ln(l_quantity + 1), 9) AS ln, round(power(l_quantity, 2), 3) AS p, CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END AS q FROM {lineitem}",
    ),
    "f5_arrays": frame(
        lambda e: e.select("vec_id", F.size("embedding").cast("long").alias("n"), F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("positive"), F.array_max("embedding").cast("double").alias("most"), F.element_at("embedding", 1).cast("double").alias("head"), F.size(F.slice("embedding", 3, 4)).cast("long").alias("part")),
        "embeddings",
        "SELECT vec_id, len(embedding) AS n, len(list_filter(embedding, lambda x: x > 0)) AS positive, list_max(embedding)::DOUBLE AS most, embedding[1]::DOUBLE AS head, len(embedding[3:6]) AS part FROM embeddings",
    ),
    "f5_vectors": frame(lambda e: _vectors(e), "embeddings", _VECTOR + "SELECT vec_id, round(sum(x * y), 9) AS d, round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 9) AS cosine FROM p GROUP BY vec_id"),
    "f6_maps": frame(
        lambda e: e.groupBy("user_id").agg(F.map_from_entries(F.collect_set(F.struct("event_type", F.length("event_type")))).alias("m")).select("user_id", F.size("m").cast("long").alias("n"), F.try_element_at("m", F.lit("view")).cast("long").alias("view"), F.size(F.map_filter("m", lambda k, v: v > 5)).cast("long").alias("long")),
        "events",
        "SELECT user_id, count(DISTINCT event_type) AS n, max(length(event_type)) FILTER (event_type = 'view') AS view, count(DISTINCT event_type) FILTER (length(event_type) > 5) AS long FROM events GROUP BY 1",
    ),
    "f7_json": frame(
        lambda e: e.select("event_id", F.get_json_object("props", "$.k").alias("text"), F.from_json("props", "k int")["k"].cast("long").alias("k"), F.try_variant_get(F.parse_json("props"), "$.k", "bigint").alias("v"), F.to_json(F.struct(F.col("event_type").alias("t"), F.col("user_id").alias("u"))).alias("made")),
        "events",
        """SELECT event_id, json_extract_string(props, '$.k') AS text, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) AS v, '{"t":"' || event_type || '","u":' || user_id || '}' AS made FROM events""",
    ),
}


def _vectors(embeddings):
    one = embeddings.where("vec_id = 0").select(F.col("embedding").alias("q"))
    both = embeddings.join(broadcast_below(one, 1000))
    return both.select("vec_id", F.round(dot(F.col("embedding"), F.col("q")), 9).alias("d"), F.round(cosine(F.col("embedding"), F.col("q")), 9).alias("cosine"))
