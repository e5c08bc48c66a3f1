"""Reading, landing, HTML, JSON and scalar functions (sections A and H)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicframe.functions import dates, similarity, text
from civicframe.functions.hashing import hash48, sql_hash48
from civicframe.plans.registry import query, same_sql
from civicframe.session import scratch_path
from civicframe.sources import files, html

# ---------------------------------------------------------------- files and tables


@query("a1_csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = scratch_path(t.spark, "customer-csv")
    files.write_table(t.customer, path, "csv")
    return files.read_csv(t.spark, path, t.customer.schema)


@query("a2_platform_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    # An export in which every file carries two platform rows above its header.
    path = scratch_path(t.spark, "platform-csv")
    cols = ["c_custkey", "c_name", "c_acctbal"]
    head = ["Export of the platform,,", "Id,Name,Balance", ",".join(cols)]
    tagged = t.customer.select(
        F.concat_ws(",", *cols).alias("value"), F.pmod(F.xxhash64("c_custkey"), F.lit(16)).alias("part"))
    heads = tagged.select("part").distinct().select(
        "part", F.posexplode(F.array(*[F.lit(h) for h in head])).alias("pos", "value"))
    lines = tagged.withColumn("pos", F.lit(len(head))).unionByName(heads)
    lines.repartition("part").sortWithinPartitions("part", "pos").drop("pos").write.partitionBy("part").text(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_acctbal", T.DoubleType())])
    return files.read_platform_csv(t.spark, path, schema)


@query("a3_parquet_sink", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def _(t):
    path = scratch_path(t.spark, "orders-parquet")
    files.write_table(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), path, partition_by=["o_orderstatus"])
    return t.spark.read.parquet(path)


@query("a4_append_load", """SELECT o_orderstatus, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def _(t):
    path = scratch_path(t.spark, "orders-table")
    name = "orders_" + path.rsplit("-", 1)[1]
    files.create_table(t.spark, name, "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE", path)
    files.append_rows(t.orders.filter("o_orderstatus = 'F'"), name)
    files.append_rows(t.orders.filter("o_orderstatus <> 'F'"), name)
    loaded = t.spark.read.parquet(path)
    t.spark.sql(f"DROP TABLE {name}")
    return loaded.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


same_sql("a6_sql_text_to_frame", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey", "nation", "region")


@query("a7_row_literals", """SELECT kind, weight, COUNT(*) AS n FROM events JOIN (VALUES ('click', 1), ('purchase', 5), ('signup', 3)) AS w(kind, weight)
ON event_type = kind GROUP BY kind, weight""")
def _(t):
    weights = t.spark.createDataFrame([("click", 1), ("purchase", 5), ("signup", 3)], "kind string, weight int")
    return t.events.join(weights, F.col("event_type") == F.col("kind")).groupBy("kind", "weight").agg(F.count(F.lit(1)).alias("n"))


same_sql("a8_page_scan", "SELECT page_id, url, LENGTH(html) AS n_chars FROM pages", "pages")


@query("a9_key_value_table", """SELECT p_partkey, row_no, k AS X1, v AS X2 FROM (
SELECT p_partkey, CAST(1 AS INT) AS row_no, 'Name' AS k, p_name AS v FROM part
UNION ALL SELECT p_partkey, 2, 'Brand', p_brand FROM part
UNION ALL SELECT p_partkey, 4, 'Size', CAST(p_size AS VARCHAR) FROM part)""")
def _(t):
    # One page per part, with a box of facts after another table and a single-cell row inside it.
    page = F.concat(
        F.lit('<html><body><table class="nav"><tr><td>a</td><td>b</td></tr></table><table class="infobox wide">'),
        F.lit("<tr><th colspan=2>Part</th></tr><tr><th>Name</th><td>"), "p_name",
        F.lit("</td></tr><tr><th>Brand</th><td><b>"), "p_brand", F.lit("</b></td></tr><tr><td>Empty</td><td></td></tr><tr><th>Size</th><td> "),
        F.col("p_size").cast("string"), F.lit("</td></tr></table></body></html>"))
    return html.key_value_table(t.part.select("p_partkey", page.alias("html")), "p_partkey", "html", "infobox")


@query("a10_links", r"""WITH l AS (SELECT DISTINCT page_id, regexp_replace(trim(regexp_replace(link, '#.*$', '')), '(.)/$', '\1') AS link FROM (
SELECT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*href=["'']([^"'']*)["'']', 1)) AS link FROM pages)) SELECT * FROM l WHERE link <> ''""")
def _(t):
    return html.links(t.pages, "page_id", "html")


UNESCAPE_SQL = "{x}"
for _name, _char in html.NAMED_CHARACTERS.items():
    UNESCAPE_SQL = "replace(" + UNESCAPE_SQL + f", '{_name}', '{_char if _char != chr(39) else chr(39) * 2}')"
SQUEEZE_SQL = "trim(regexp_replace({x}, '[\\s\u00a0]+', ' ', 'g'))"


def _text_sql(x: str) -> str:
    return SQUEEZE_SQL.format(x=UNESCAPE_SQL.format(x=f"regexp_replace({x}, '<[^>]*>', '', 'g')"))


@query("a11_heading_and_list_text", "SELECT page_id, tag, txt AS \"text\" FROM (" + " UNION ALL ".join(
    f"SELECT page_id, '{tag}' AS tag, {_text_sql('unnest(regexp_extract_all(html, ' + chr(39) + '(?is)<' + tag + r'(?:\s[^>]*)?>(.*?)</' + tag + '>' + chr(39) + ', 1))')} AS txt FROM pages"
    for tag in ("h1", "li")) + ") WHERE txt <> ''")
def _(t):
    parts = [t.pages.select("page_id", F.lit(tag).alias("tag"), F.explode(html.tag_texts(F.col("html"), tag)).alias("text"))
             for tag in ("h1", "li")]
    return parts[0].unionByName(parts[1])


# Names and values of the profile pages are derived from the parts.
TITLE_PATTERN = r"Associate Professor of [A-Za-z ]+ \d+"
EMAIL_IN_TEXT = r"[A-Za-z0-9._%+-]+@example\.edu"


@query("a12_profile_sections", """SELECT p_partkey, 'Associate Professor of ' || p_type || ' ' || p_size AS scraped_title, 'p' || p_partkey || '@example.edu' AS scraped_email,
split_part(p_name, ' ', 1) || '; ' || split_part(p_name, ' ', 2) || '; ' || p_brand || ' studies' AS scraped_interests, CAST(3 AS INT) AS n_interest_items FROM part""")
def _(t):
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    page = F.concat(
        F.lit("<html><head><title>x</title></head><body><h1>Staff</h1><p>Associate Professor of "), "p_type", F.lit(" "),
        F.col("p_size").cast("string"), F.lit("</p><p>Mail: p"), F.col("p_partkey").cast("string"),
        F.lit("@example.edu or other@example.edu</p><h2> Areas of Interest </h2><p>see</p><ul><li>"), first, F.lit("</li><li> </li><li><i>"), second,
        F.lit("</i></li></ul><ul><li>not this</li></ul><h3>Research Interests</h3><p>"), "p_brand", F.lit(" studies</p><p>not this</p></body></html>"))
    rows = html.profile_rows(t.part.select("p_partkey", page.alias("html")), "html", TITLE_PATTERN, EMAIL_IN_TEXT)
    return rows.drop("html")


@query("a13_body_text", "SELECT page_id, md5(txt) AS digest, LENGTH(txt) AS n_chars FROM (SELECT page_id, " + SQUEEZE_SQL.format(x=UNESCAPE_SQL.format(
    x="regexp_replace(regexp_replace(regexp_replace(html, '(?is)^.*?<body[^>]*>', ''), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')")) + " AS txt FROM pages)")
def _(t):
    body = html.body_text(F.col("html"))
    return t.pages.select("page_id", F.md5(body.cast("binary")).alias("digest"), F.length(body).alias("n_chars"))


@query("a14_flatten_json", """SELECT o_orderkey, o_orderpriority AS "bib.title", CAST(year(o_orderdate) AS INT) AS "bib.year" FROM orders""")
def _(t):
    bib = F.struct(F.col("o_orderpriority").alias("title"), F.year("o_orderdate").alias("year"))
    raw = t.orders.select("o_orderkey", F.to_json(F.struct(bib.alias("bib"), F.col("o_totalprice").alias("n"))).alias("body"))
    flat = files.flatten_records(raw, "body", "bib struct<title string, year int>", ["bib.title", "bib.year"])
    return flat


@query("a14_event_props", """SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events""")
def _(t):
    return files.flatten_records(t.events.select("event_id", "props"), "props", "k int", ["k"])


@query("a15_map_to_rows", """SELECT o_custkey AS name, CAST(year(o_orderdate) AS INT) AS year, COUNT(*) AS cites FROM orders GROUP BY 1, 2""")
def _(t):
    yearly = t.orders.groupBy(F.col("o_custkey").alias("name"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("cites"))
    # One entry per calendar year, so the map of an entity stays short.
    maps = yearly.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("year", "cites"))).alias("cites_per_year"))
    return files.map_to_rows(maps, "name", "cites_per_year", "year", "cites").orderBy("name", "year")


def landed_responses(t):
    path = scratch_path(t.spark, "responses")
    raw = t.events.select(
        F.col("event_type").alias("endpoint"), F.concat(F.lit("user="), F.col("user_id").cast("string")).alias("params"),
        (F.col("event_id") % 3).alias("page"), F.col("ts").alias("fetched_at"),
        F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "props": '), "props", F.lit("}")).alias("body"))
    early = F.col("fetched_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    files.land_responses(raw.filter(early), path)
    files.land_responses(raw.filter(~early), path)
    return files.read_responses(t.spark, path)


@query("a16_latest_response", """SELECT endpoint, params, page, arg_max(event_id, (fetched_at, event_id)) AS event_id FROM (SELECT event_type AS endpoint, 'user=' || user_id AS params,
event_id % 3 AS page, date_trunc('millisecond', ts) AS fetched_at, event_id FROM events) GROUP BY ALL""")
def _(t):
    latest = files.latest_responses(landed_responses(t))
    return latest.select("endpoint", "params", "page", F.get_json_object("body", "$.id").cast("bigint").alias("event_id"))


@query("a16_provenance", """SELECT event_type AS endpoint, 'user=' || user_id AS params, COUNT(DISTINCT event_id % 3) AS n_pages, COUNT(*) AS n_fetches,
CAST(CAST(MIN(ts) AS DATE) AS VARCHAR) AS first_fetch, CAST(CAST(MAX(ts) AS DATE) AS VARCHAR) AS last_fetch FROM events GROUP BY 1, 2""")
def _(t):
    return files.provenance(landed_responses(t)).withColumns({
        c: F.col(c).cast("date").cast("string") for c in ("first_fetch", "last_fetch")})


@query("a17_series_window", """SELECT o_orderpriority AS series_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, ROUND(SUM(o_totalprice), 2) AS value FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31' GROUP BY 1, 2""")
def _(t):
    daily = t.orders.groupBy(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("date")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("value"))
    kept = files.series_window(daily, ["1-URGENT", "5-LOW"], "1996-01-01", "1998-12-31")
    return kept.withColumn("date", F.col("date").cast("string"))


@query("a19_text_lines", """SELECT line, COUNT(*) AS n FROM (SELECT c_mktsegment || ' ' || c_nationkey AS line FROM customer) GROUP BY line""")
def _(t):
    path = scratch_path(t.spark, "contacts")
    t.customer.select(F.concat_ws(" ", "c_mktsegment", "c_nationkey").alias("value")).write.text(path)
    return files.read_lines(t.spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("a20_run_log", """SELECT 'loaded' AS step, COUNT(*) AS n_rows, 'seed-1' AS seed FROM customer
UNION ALL SELECT 'positive balance', COUNT(*), 'seed-1' FROM customer WHERE c_acctbal > 0""")
def _(t):
    log = files.RunLog(t.spark, "seed-1")
    loaded = log.step("loaded", t.customer)
    cleaned = log.step("positive balance", loaded.filter("c_acctbal > 0"))
    path = files.zone_path(scratch_path(t.spark, "run"), "processed", "customer")
    files.write_table(cleaned, path)
    return log.rows(path).select("step", F.col("rows").alias("n_rows"), "seed")


# ---------------------------------------------------------------- scalar functions

@query("h1_detect", """SELECT doc_id, regexp_matches(text, 'the') AS anywhere, regexp_matches(text, '^[A-E]') AS anchored_start, regexp_matches(text, '\\.$') AS anchored_end FROM documents""")
def _(t):
    x = F.col("text")
    return t.documents.select("doc_id", text.detect(x, "the").alias("anywhere"), text.detect(x, "^[A-E]").alias("anchored_start"),
                              text.detect(x, r"\.\z").alias("anchored_end"))


@query("h2_extract_all", """SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS number FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.explode(text.extract_all(F.col("text"), "[0-9]+")).alias("number"))


@query("h3_match_groups", r"""SELECT order_text, regexp_extract(order_text, '(\d{4})-(\d{2})-(\d{2})', 0) AS "full", regexp_extract(order_text, '(\d{4})-(\d{2})-(\d{2})', 1) AS y,
regexp_extract(order_text, '(\d{4})-(\d{2})-(\d{2})', 3) AS d FROM (SELECT 'Order ' || o_orderkey || ' of ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_text FROM orders)""")
def _(t):
    line = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" of "), F.to_date("o_orderdate").cast("string"))
    m = text.match(F.col("order_text"), r"(\d{4})-(\d{2})-(\d{2})", 3)
    return t.orders.select(line.alias("order_text")).select("order_text", m[0].alias("full"), m[1].alias("y"), m[3].alias("d"))


@query("h4_replace_backreferences")
def _(t):
    return t.pages.select("page_id", text.replace_all(F.col("html"), r"<(\w+)>(.*?)</\1>", "[$2]").alias("text"))


@query("h4_replace_groups", r"""SELECT c_custkey, regexp_replace(c_name, '([A-Za-z]+)#0*([0-9]+)', '[\2] \1', 'g') AS name FROM customer""")
def _(t):
    return t.customer.select("c_custkey", text.replace_all(F.col("c_name"), "([A-Za-z]+)#0*([0-9]+)", "[$2] $1").alias("name"))


@query("h5_email_check", r"""SELECT doc_id, word, regexp_matches(word, '^[\w\.]+@[\w\.]+\.\w+$') AS valid FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^ \n\t]*@[^ \n\t]*')) AS word FROM documents)""")
def _(t):
    words = t.documents.select("doc_id", F.explode(text.extract_all(F.col("text"), r"[^ \n\t]*@[^ \n\t]*")).alias("word"))
    return words.withColumn("valid", text.is_email(F.col("word"), unicode_words=False))


@query("h6_url_extract", r"""SELECT page_id, unnest(regexp_extract_all(url || ' and www.' || page_id || '.example.org', 'https?://[\w\d\.-]+\.\w{2,}|www\.[\w\d\.-]+\.\w{2,}')) AS found FROM pages""")
def _(t):
    line = F.concat("url", F.lit(" and www."), F.col("page_id").cast("string"), F.lit(".example.org"))
    return t.pages.select("page_id", F.explode(text.urls(line)).alias("found"))


# The other engine has no look-around: it matches the neighbouring characters, in two passes.
PHONE_SQL = r"(^|[^0-9])\(?([0-9]{3})\)?[-. ]?([0-9]{3})[-. ]?([0-9]{4})($|[^0-9])"
_ONCE = f"regexp_replace(@x@, '{PHONE_SQL}', '\\1(\\2) \\3-\\4\\5', 'g')"


@query("h7_phone_format", "SELECT doc_id, md5(" + _ONCE.replace("@x@", _ONCE.replace("@x@", "text")) + ") AS digest FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(text.standard_phones(F.col("text")).cast("binary")).alias("digest"))


@query("h8_password_strength", """SELECT c_custkey, length(p) >= 8 AND regexp_matches(p, '[A-Z]') AND regexp_matches(p, '[a-z]') AND regexp_matches(p, '[0-9]') AND regexp_matches(p, '[@$!%*?&]') AS strong
FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || '!' WHEN 1 THEN c_name ELSE '$' || lower(c_name) END AS p FROM customer)""")
def _(t):
    word = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit("!"))).when(
        F.col("c_custkey") % 3 == 1, F.col("c_name")).otherwise(F.concat(F.lit("$"), F.lower("c_name")))
    return t.customer.select("c_custkey", text.strong_password(word).alias("strong"))


@query("h9_first_match", """SELECT doc_id, trim(regexp_extract(text, '[A-Z][a-z]+ [a-z]+', 0)) AS opening FROM documents""")
def _(t):
    return t.documents.select("doc_id", text.first_match(F.col("text"), "[A-Z][a-z]+ [a-z]+").alias("opening"))


@query("h10_fold_contains_squeeze", """SELECT p_partkey, lower(p_type) AS kind, contains(lower(p_name), 'ring') AS is_ring, trim(regexp_replace('  ' || p_name || '  ' || p_brand || ' ', '\\s+', ' ', 'g')) AS label FROM part""")
def _(t):
    return t.part.select("p_partkey", F.lower("p_type").alias("kind"), F.lower("p_name").contains("ring").alias("is_ring"),
                         text.squeeze(F.concat(F.lit("  "), "p_name", F.lit("  "), "p_brand", F.lit(" "))).alias("label"))


@query("h11_list_columns", """SELECT p_partkey, len(l) AS n_items, array_to_string(l, '; ') AS items, array_to_string(l[1:2], '|') AS first_two FROM (
SELECT p_partkey, list_filter(list_transform(list_concat(string_split(p_name, ' '), ['', ' ', p_brand]), lambda x: trim(x)), lambda x: x <> '') AS l FROM part)""")
def _(t):
    items = text.drop_blank(F.concat(F.split("p_name", " "), F.array(F.lit(""), F.lit(" "), F.col("p_brand"))))
    return t.part.select("p_partkey", F.size(items).cast("bigint").alias("n_items"), F.array_join(items, "; ").alias("items"),
                         F.array_join(F.slice(items, 1, 2), "|").alias("first_two"))


NAME_PAIRS = """SELECT DISTINCT split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, p_brand AS c, p_type AS d FROM part"""


def name_pairs(t):
    return t.part.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("a"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("b"),
                         F.col("p_brand").alias("c"), F.col("p_type").alias("d")).distinct()


@query("h12_levenshtein", f"SELECT a, b, c, d, levenshtein(a, b) AS dist_ab, levenshtein(c, d) AS dist_cd FROM ({NAME_PAIRS})")
def _(t):
    return name_pairs(t).withColumns({"dist_ab": F.levenshtein("a", "b").cast("bigint"), "dist_cd": F.levenshtein("c", "d").cast("bigint")})


@query("h13_jaro_winkler", f"SELECT a, b, c, d, ROUND(jaro_winkler_similarity(a, b), 6) AS sim FROM ({NAME_PAIRS})")
def _(t):
    return similarity.with_jaro_winkler(name_pairs(t), "a", "b", "sim").withColumn("sim", F.round("sim", 6))


@query("h14_gaussian_similarity", "SELECT p_partkey, ROUND(pow(2, -pow(greatest(abs(p_size - 25) - 1.0, 0) / 2.0, 2)), 9) AS sim FROM part")
def _(t):
    return t.part.select("p_partkey", F.round(similarity.gaussian_similarity(F.col("p_size"), F.lit(25), 1.0, 2.0), 9).alias("sim"))


@query("h15_exact_and_difference", "SELECT p_partkey, CAST(p_type = 'SMALL' AS INT) AS same, abs(p_size - 25) AS diff FROM part")
def _(t):
    return t.part.select("p_partkey", similarity.exact(F.col("p_type"), F.lit("SMALL")).alias("same"), F.abs(F.col("p_size") - 25).alias("diff"))


@query("h16_math", """SELECT c_custkey, ROUND(CASE WHEN c_acctbal > 0 THEN LN(c_acctbal) ELSE 0 END, 6) AS ln, ROUND(LN(1 + abs(c_acctbal)), 6) AS log1p, ROUND(1 / (1 + EXP(-c_acctbal / 1000)), 9) AS logistic,
ROUND(SQRT(abs(c_acctbal)), 6) AS root, ROUND(SIN(c_acctbal), 6) AS sine, CAST(FLOOR(c_acctbal) AS BIGINT) AS whole FROM customer""")
def _(t):
    x = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.round(F.when(x > 0, F.log(x)).otherwise(0.0), 6).alias("ln"), F.round(F.log1p(F.abs(x)), 6).alias("log1p"),
        F.round(1 / (1 + F.exp(-x / 1000)), 9).alias("logistic"), F.round(F.sqrt(F.abs(x)), 6).alias("root"), F.round(F.sin(x), 6).alias("sine"),
        F.floor(x).alias("whole"))


@query("h17_dates", """SELECT event_id, CAST(year(ts) AS INT) AS y, CAST(quarter(ts) AS INT) AS q, CAST(isodow(ts) AS INT) AS dow, isodow(ts) >= 6 AS weekend,
CAST(CAST(ts AS DATE) + 10 AS VARCHAR) AS plus_ten, strftime(date_trunc('second', ts) + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS utc, event_id % 2 = 0 AS parsed FROM events""")
def _(t):
    typed = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = F.when(F.col("event_id") % 2 == 0, typed).otherwise(F.lit("not a date"))
    ts = F.col("ts")
    return t.events.select(
        "event_id", F.year(ts).alias("y"), F.quarter(ts).alias("q"), dates.iso_weekday(ts).alias("dow"), dates.is_weekend(ts).alias("weekend"),
        F.date_add(F.to_date(ts), 10).cast("string").alias("plus_ten"),
        F.date_format(dates.localise(dates.parse_time(typed), "America/New_York"), "yyyy-MM-dd HH:mm:ss").alias("utc"),
        dates.parse_time(raw).isNotNull().alias("parsed"))


@query("h18_duration", "SELECT event_id, ROUND(value / 60.0, 9) AS minutes FROM events")
def _(t):
    return t.events.select("event_id", F.round(dates.minutes(F.col("value")), 9).alias("minutes"))


@query("h19_struct_to_json", """SELECT event_id, '[{"field":"' || event_type || '","quote":"' || user_id || '"}]' AS evidence FROM events""")
def _(t):
    evidence = F.array(F.struct(F.col("event_type").alias("field"), F.col("user_id").cast("string").alias("quote")))
    return t.events.select("event_id", F.to_json(evidence).alias("evidence"))


@query("h20_dummies", "SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS is_building FROM customer")
def _(t):
    return t.customer.select("c_custkey", (F.col("c_mktsegment") == "BUILDING").cast("double").alias("is_building"))


@query("hash_uniform_and_normal", f"""SELECT c_custkey, {sql_hash48('u', 'c_custkey')} AS h, ROUND({sql_hash48('u', 'c_custkey')} / 281474976710656.0, 9) AS u FROM customer""")
def _(t):
    from civicframe.functions.hashing import to_unit

    return t.customer.select("c_custkey", hash48("u", "c_custkey").alias("h")).withColumn("u", F.round(to_unit(F.col("h")), 9))
