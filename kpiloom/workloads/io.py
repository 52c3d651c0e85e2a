"""Source and sink queries.  Data-moving keys are round trips: a test table is
written to a fresh folder under the shared checkpoint folder, read back, and
compared with the plain source table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from kpiloom.functions.search import search_any
from kpiloom.operators import rules as R
from kpiloom.session import scratch_path
from kpiloom.sources import files as FS
from kpiloom.sources import sinks as SK
from kpiloom.sources.catalog import register_sheets, run_sql
from kpiloom.sources.html import read_html_table, table_html
from kpiloom.sources.html_grid import read_html_grid
from kpiloom.sources.scheme import load_scheme
from kpiloom.sources.tables import register_tables, table
from kpiloom.sources.typed_csv import read_csv_typed
from kpiloom.sources.workbook import read_sheet
from kpiloom.workloads import as_double, register, ts_text


def T(spark, sf_dir, name):
    return table(spark, sf_dir, name)


SRC_SQL = """
SELECT o_orderpriority, o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders GROUP BY o_orderpriority, o_orderstatus"""


@register("src_sql", SRC_SQL)
def q_src_sql(spark, sf_dir):
    register_tables(spark, sf_dir, ["orders"])
    df, err = run_sql(spark, SRC_SQL)
    if err:
        raise RuntimeError(err)
    return df


CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _typed_customer(df):
    return df.select(F.col("c_custkey").cast("bigint"), F.col("c_name").cast("string"),
                     F.col("c_nationkey").cast("int"), F.col("c_acctbal").cast("double"),
                     F.col("c_mktsegment").cast("string"))


@register("src_csv", CUSTOMER_SQL)
def q_src_csv(spark, sf_dir):
    path = scratch_path(spark, "customer_csv")
    T(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return _typed_customer(FS.read_csv(spark, path))


@register("src_multi", """
SELECT 'nation' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows FROM nation
UNION ALL SELECT 'region', COUNT(*) FROM region
UNION ALL SELECT 'supplier', COUNT(*) FROM supplier""")
def q_src_multi(spark, sf_dir):
    folder = scratch_path(spark, "book")
    for n in ("nation", "region", "supplier"):
        T(spark, sf_dir, n).write.option("header", True).csv(f"{folder}/{n}.csv")
    tables, _skipped = FS.read_folder(spark, folder, "csv", existing={"customer"})
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


HTML_COLS = ["c_custkey", "c_name", "c_mktsegment"]


@register("src_html_table", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_src_html_table(spark, sf_dir):
    # Render customers as HTML documents of at most 100 rows each (chunk =
    # key / 100), then read every document's first table back.
    c = T(spark, sf_dir, "customer").withColumn("chunk", F.floor(F.col("c_custkey") / 100))
    docs = table_html(c, ["chunk"], HTML_COLS, "c_custkey")
    rows = read_html_table(docs, "html", HTML_COLS, keep=["chunk"])
    return rows.select(F.col("c_custkey").cast("bigint"), "c_name", "c_mktsegment")


@register("src_html_grid", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_src_html_grid(spark, sf_dir):
    # Customers as documents of at most 100 rows; the customers of a segment stand together behind one cell that
    # spans their rows, names write # by number, and each name cell holds a table of its own.
    at = Window.partitionBy("chunk", "c_mktsegment")
    c = (T(spark, sf_dir, "customer").withColumn("chunk", F.floor(F.col("c_custkey") / 100))
         .withColumn("first", F.min("c_custkey").over(at) == F.col("c_custkey")).withColumn("n", F.count("*").over(at)))
    name = F.replace("c_name", F.lit("#"), F.lit("&#35;"))
    row = F.concat(F.lit("<tr>"), F.when(F.col("first"), F.concat(F.lit("<td rowspan="), F.col("n").cast("string"), F.lit(">"), F.col("c_mktsegment"), F.lit("</td>")))
                   .otherwise(""), F.lit("<td>"), F.col("c_custkey").cast("string"), F.lit("<td><b>"), name, F.lit("</b><table><tr><td>note</table></tr>"))
    rows = F.sort_array(F.collect_list(F.struct("c_mktsegment", "c_custkey", row.alias("tr"))))
    docs = c.groupBy("chunk").agg(F.concat(F.lit("<table><tr><th>C MktSegment<th>C CustKey<th>C Name</tr>"),
                                           F.array_join(F.transform(rows, lambda r: r["tr"]), ""), F.lit("</table>")).alias("html"))
    return read_html_grid(docs, "html", HTML_COLS).select(F.col("c_custkey").cast("bigint"), "c_name", "c_mktsegment")


@register("src_csv_typed", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 50 <> 0 THEN c_acctbal END AS c_acctbal, c_custkey % 50 = 0 AS set_aside FROM customer""")
def q_src_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "customer_mixed_csv")
    balance = F.when(F.col("c_custkey") % 50 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    T(spark, sf_dir, "customer").select("c_custkey", "c_name", balance.alias("c_acctbal")).write.option("header", True).csv(path)
    kept, aside = read_csv_typed(spark, path, tolerance=0.05)
    kept = kept.select("c_custkey", "c_name", "c_acctbal", F.lit(False).alias("set_aside"))
    return kept.unionByName(aside.select(F.col("c_custkey").cast("bigint"), "c_name", F.lit(None).cast("double").alias("c_acctbal"),
                                         (F.col("misfits") == F.array(F.lit("c_acctbal"))).alias("set_aside")))


def _books(spark, sf_dir):
    """(chunk, content): orders as workbooks of at most 500 rows, a sheet of orders and one of their days and states."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    o = o.withColumn("chunk", F.floor(F.col("o_orderkey") / 500).cast("long")).withColumn(
        "day", F.datediff("o_orderdate", F.lit("1899-12-30").cast("date"))).drop("o_orderdate")

    def book(pdf):
        import io
        import zipfile
        head = '<?xml version="1.0" encoding="UTF-8"?>'
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        states = sorted(set(pdf["o_orderstatus"]))

        def sheet(header, rows):
            own = "".join(f'<c t="inlineStr"><is><t>{h}</t></is></c>' for h in header)
            return f"{head}<worksheet {ns}><sheetData><row>{own}</row>" + "".join(f"<row>{r}</row>" for r in rows) + "</sheetData></worksheet>"

        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("xl/workbook.xml", f'{head}<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="Orders" sheetId="1" r:id="a"/><sheet name="Days" sheetId="2" r:id="b"/></sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="a" Target="worksheets/s1.xml"/><Relationship Id="b" Target="/xl/worksheets/s2.xml"/></Relationships>')
            z.writestr("xl/sharedStrings.xml", f"{head}<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in states) + "</sst>")
            z.writestr("xl/styles.xml", f'{head}<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
            z.writestr("xl/worksheets/s1.xml", sheet(["key", "customer", "price"], [f"<c><v>{k}</v></c><c><v>{c}</v></c><c><v>{p!r}</v></c>" for k, c, p in zip(pdf["o_orderkey"].tolist(), pdf["o_custkey"].tolist(), pdf["o_totalprice"].tolist())]))
            z.writestr("xl/worksheets/s2.xml", sheet(["key", "day", "state"], [f'<c><v>{k}</v></c><c s="1"><v>{d}</v></c><c t="s"><v>{states.index(s)}</v></c>' for k, d, s in zip(pdf["o_orderkey"], pdf["day"], pdf["o_orderstatus"])]))
        return pdf[["chunk"]].head(1).assign(content=[out.getvalue()])

    return o.groupBy("chunk").applyInPandas(book, "chunk long, content binary")


@register("src_workbook", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders""")
def q_src_workbook(spark, sf_dir):
    path = scratch_path(spark, "order_books")
    _books(spark, sf_dir).write.parquet(path)
    books = spark.read.parquet(path)
    orders = read_sheet(books, "Orders", ["key", "o_custkey", "o_totalprice"])
    days = read_sheet(books, "Days", ["key", "order_day", "o_orderstatus"])
    return orders.join(days, "key").select(F.col("key").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint"),
                                           F.col("o_totalprice").cast("double"), "o_orderstatus", "order_day")


ORDER_JSON_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
    StructField("o_orderdate", StringType()), StructField("__error__", StringType()),
])


@register("src_json", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate
FROM orders""")
def q_src_json(spark, sf_dir):
    path = scratch_path(spark, "orders_json")
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                          ts_text("o_orderdate").alias("o_orderdate"))
    FS.write_result_json(o, path)
    df, status, err = FS.read_result_json(spark, path, ORDER_JSON_SCHEMA)
    if status != "success":
        raise RuntimeError(err)
    return df


CHANNELS = [("1-URGENT", "DIRECT"), ("2-HIGH", "DIRECT"), ("3-MEDIUM", "PARTNER"), ("5-LOW", "WALKIN")]


@register("src_inline", """
WITH ch(priority, channel) AS (VALUES ('1-URGENT', 'DIRECT'), ('2-HIGH', 'DIRECT'), ('3-MEDIUM', 'PARTNER'),
                                      ('5-LOW', 'WALKIN'))
SELECT COALESCE(ch.channel, 'Unknown') AS channel, CAST(COUNT(*) AS BIGINT) AS insp,
       CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS si
FROM orders LEFT JOIN ch ON o_orderpriority = ch.priority GROUP BY 1""")
def q_src_inline(spark, sf_dir):
    ch = FS.inline(spark, CHANNELS, "priority string, channel string")
    o = T(spark, sf_dir, "orders")
    j = o.join(ch, o.o_orderpriority == ch.priority, "left")   # literal rows: fixed size
    return j.groupBy(F.coalesce(F.col("channel"), F.lit("Unknown")).alias("channel")).agg(
        F.count(F.lit(1)).alias("insp"), F.count_if(F.col("o_orderstatus") == "F").alias("si"))


@register("src_scheme", """
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY 1, 2),
slab(condition, lo, hi, amount) AS (VALUES
  ('T7 Regions', 3, 3, 0.0), ('T7 Regions', 4, 4, 0.0), ('T7 Regions', 5, 5, 100.0), ('T7 Regions', 6, 6, 300.0),
  ('T7 Regions', 7, 7, 500.0), ('T7 Regions', 8, 8, 800.0), ('T7 Regions', 9, NULL, 1000.0),
  ('Non T7', 3, 3, 0.0), ('Non T7', 4, 4, 50.0), ('Non T7', 5, 5, 150.0), ('Non T7', 6, 6, 300.0),
  ('Non T7', 7, 7, 500.0), ('Non T7', 8, 8, 700.0), ('Non T7', 9, NULL, 1000.0))
SELECT condition, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, CAST(amount AS DOUBLE) AS amount,
       CAST(COUNT(d) AS BIGINT) AS person_days
FROM slab LEFT JOIN daily ON n >= lo AND (hi IS NULL OR n <= hi)
GROUP BY condition, lo, hi, amount""")
def q_src_scheme(spark, sf_dir):
    # How many person-days each productivity slab of the scheme covers.
    slabs = R.slabs(R.scheme_parse(load_scheme(spark)), "Productivity")
    daily = R.daily_counts(T(spark, sf_dir, "events"), "user_id", "ts")
    cond = (daily.n >= slabs.lo) & (slabs.hi.isNull() | (daily.n <= slabs.hi))
    hits = daily.join(slabs, cond).groupBy("condition", "lo", "hi", "amount").agg(
        F.count(F.lit(1)).alias("person_days"))
    h = hits.alias("h")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("condition", "lo", "hi", "amount")]
    out = slabs.alias("s").join(h, same[0] & same[1] & same[2] & same[3], "left").select(
        "s.condition", "s.lo", "s.hi", "s.amount",
        F.coalesce("h.person_days", F.lit(0)).cast("bigint").alias("person_days"))
    return as_double(out, "lo", "hi")


@register("norm_headers", CUSTOMER_SQL)
def q_norm_headers(spark, sf_dir):
    c = T(spark, sf_dir, "customer")
    shouting = c.toDF(*[x.replace("_", " ").title() for x in c.columns])   # "C Custkey", ...
    return FS.norm_headers(shouting, required=list(c.columns))


@register("view_register", """
SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n_orders FROM orders GROUP BY o_orderstatus""")
def q_view_register(spark, sf_dir):
    register_sheets({"Order Sheet": T(spark, sf_dir, "orders")})
    df, err = run_sql(spark, "SELECT o_orderstatus, COUNT(*) AS n_orders FROM order_sheet GROUP BY o_orderstatus")
    if err:
        raise RuntimeError(err)
    return df


@register("sink_report", """
SELECT 'Urgent_Orders' AS sheet_name, 'urgent orders' AS query_name, CAST(COUNT(*) AS BIGINT) AS row_count
FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'events per user - long name cut to thirty one chars', 'events per user - long name cut to thirty one chars',
       CAST(COUNT(DISTINCT user_id) AS BIGINT) FROM events""")
def q_sink_report(spark, sf_dir):
    root = scratch_path(spark, "report")
    register_tables(spark, sf_dir, ["orders", "events"])
    qs = [("urgent orders", "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'"),
          ("events per user - long name cut to thirty one chars", "SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id"),
          ("broken", "SELECT nope FROM orders")]
    results = []
    for name, sql in qs:
        df, err = run_sql(spark, sql)
        results.append((name, df, "failed" if err else "success"))
    SK.write_report(spark, results, root, mapping={"urgent orders": "Urgent_Orders"})
    return spark.read.parquet(f"{root}/_manifest").select("sheet_name", "query_name", "row_count")


@register("sink_append", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders""")
def q_sink_append(spark, sf_dir):
    path = scratch_path(spark, "appended")
    o = T(spark, sf_dir, "orders")
    SK.append_positional(o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice"), path)
    # second batch with other column names: matched by position
    SK.append_positional(o.where(F.col("o_orderstatus") != "F").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_totalprice").alias("p")), path)
    return spark.read.parquet(path)


SINK_CSV_SCHEMA = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()),
                              StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
                              StructField("c_mktsegment", StringType())])


@register("sink_csv", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE regexp_matches(CAST(c_custkey AS VARCHAR), 'machinery', 'i') OR regexp_matches(c_name, 'machinery', 'i')
   OR regexp_matches(CAST(c_nationkey AS VARCHAR), 'machinery', 'i')
   OR regexp_matches(CAST(c_acctbal AS VARCHAR), 'machinery', 'i') OR regexp_matches(c_mktsegment, 'machinery', 'i')""")
def q_sink_csv(spark, sf_dir):
    # A searched view (any column) exported as CSV with the _filtered suffix, read back.
    hits = search_any(T(spark, sf_dir, "customer"), "machinery")
    target = SK.write_csv(hits, scratch_path(spark, "customers"), filtered=True)
    if not target.endswith("_filtered"):
        raise RuntimeError("filtered export must carry the _filtered suffix")
    return FS.read_csv(spark, target, schema=SINK_CSV_SCHEMA)


RUNLOG_FROM_EVENTS = """
SELECT 'q' || CAST(event_id AS VARCHAR) AS query_name, event_type AS sheet_name,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
       value AS execution_time, CASE WHEN event_type = 'error' THEN 0 ELSE user_id END AS row_count
FROM events"""


def runlog_from_events(spark, sf_dir):
    e = T(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    return e.select(
        F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("query_name"),
        F.col("event_type").alias("sheet_name"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.col("ts").cast("timestamp").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("value"))).cast("timestamp").alias("end_time"),
        F.col("value").alias("execution_time"),
        F.when(failed, F.lit(0)).otherwise(F.col("user_id")).cast("bigint").alias("row_count"),
        F.when(failed, F.lit("error event")).alias("error"))


@register("sink_runlog", RUNLOG_FROM_EVENTS)
def q_sink_runlog(spark, sf_dir):
    path = scratch_path(spark, "runlog")
    SK.append_runlog(runlog_from_events(spark, sf_dir), path)
    return spark.read.parquet(path).select("query_name", "sheet_name", "status", "execution_time", "row_count")


@register("ws_save_load", """
SELECT 'customers' AS name, 'sql' AS type, 'success' AS status, CAST(COUNT(*) AS DOUBLE) AS row_count FROM customer
UNION ALL SELECT 'no_orders', 'sql', 'pending', NULL
UNION ALL SELECT 'events_per_user', 'kpi', 'success', CAST(COUNT(DISTINCT user_id) AS DOUBLE) FROM events""")
def q_ws_save_load(spark, sf_dir):
    root = scratch_path(spark, "workspaces")
    sheets = {
        "customers": (T(spark, sf_dir, "customer"), "sql", "SELECT * FROM customer"),
        "no_orders": (T(spark, sf_dir, "orders").where(F.col("o_totalprice") < 0), "sql", "SELECT ..."),
        "events_per_user": (T(spark, sf_dir, "events").groupBy("user_id").count(), "kpi", "SELECT ..."),
        "scheme": (load_scheme(spark), "scheme", None),
    }
    SK.save_workspace(spark, root, "alice", sheets)
    meta, tables = SK.load_workspace(spark, root, "alice")
    counts = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        counts = c if counts is None else counts.unionByName(c)
    return as_double(meta.join(counts, "name", "left").select("name", "type", "status", "row_count"), "row_count")


@register("ts_naive", """
SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS local_ts FROM events""")
def q_ts_naive(spark, sf_dir):
    e = T(spark, sf_dir, "events").select("event_id", "ts")
    return FS.strip_zone(e, "Asia/Kolkata", ["ts"], from_zone="UTC").select(
        "event_id", ts_text("ts").alias("local_ts"))
