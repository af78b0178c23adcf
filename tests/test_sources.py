"""Scans and sinks: CSV/JSON round trips, point-map JSON with bad input,
HTML table rows, incremental ingest run twice."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import make_ticks
from tickweave.sources import (
    html_table_rows,
    point_rejects,
    read_point_json,
    read_ticks_csv,
    read_ticks_json,
    write_ticks,
)
from tickweave.streaming import ingest_new


def _tmp():
    return tempfile.mkdtemp(prefix="tickweave-test-")


def test_csv_in_reference_layout(spark):
    d = _tmp()
    p = os.path.join(d, "ticks.csv")
    with open(p, "w") as f:
        f.write(",Currency,DateTime,Price USD,Trading Volume Last 24h,Market Cap,Price BTC,DunnoWhatThisIs\n")
        f.write("7,Stellar,2019-01-01 00:05:00,0.11,100.0,2000.0,0.00003,\n")
        f.write("3,Stellar,2019-01-01 00:00:00,0.0,0.0,1999.0,0.00003,1.5\n")
        f.write("4,Bitcoin,2019-01-01 00:00:00,3800.5,1e9,6.6e10,1.0,oops\n")
    df = read_ticks_csv(spark, p)
    assert df.columns == ["event_id", "currency", "dt", "price", "volume", "market_cap", "price_btc", "extra"]
    rows = {r["event_id"]: r for r in df.collect()}
    assert rows[3]["price"] == 0.0 and rows[7]["extra"] is None and rows[4]["price"] == 3800.5


def test_sorted_sink_round_trip_csv_and_json(spark):
    df = make_ticks(spark, [("a", 300 - i, i, float(i), 1.0, 2.0) for i in range(50)])
    for fmt in ("csv", "json", "parquet"):
        d = os.path.join(_tmp(), fmt)
        write_ticks(df, d, fmt)
        if fmt == "parquet":
            back = spark.read.parquet(d)
        elif fmt == "csv":
            back = spark.read.schema(df.schema).option("header", True).option(
                "timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(d)
        else:
            back = spark.read.schema(df.schema).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").json(d)
        assert back.count() == 50
        assert [r["event_id"] for r in back.collect()] == list(range(49, -1, -1))


def test_ticks_json_lines(spark):
    d = _tmp()
    p = os.path.join(d, "t.json")
    with open(p, "w") as f:
        f.write(json.dumps({"_c0": 1, "Currency": "Zilliqa", "DateTime": "2020-01-01 00:00:00", "Price USD": 0.5}) + "\n")
    r = read_ticks_json(spark, p).first()
    assert r["currency"] == "Zilliqa" and r["price"] == 0.5 and r["volume"] is None


def _write_points(root, coin, day, points):
    os.makedirs(os.path.join(root, coin), exist_ok=True)
    with open(os.path.join(root, coin, f"{day}.json"), "w") as f:
        if isinstance(points, str):
            f.write(points)
        else:
            json.dump({"data": {"points": points}}, f)


def test_point_json_skips_bad_points_not_files(spark):
    root = _tmp()
    _write_points(root, "bitcoin", "20190101", {
        "1546300800": {"v": [3800.0, 1e9, 6.6e10, 1.0, None]},
        "1546301100": {"v": [3801.0, 1e9]},
        "notanumber": {"v": [1.0, 2.0, 3.0, 4.0, 5.0]},
    })
    _write_points(root, "ethereum", "20190101", "{ this is not json")
    _write_points(root, "ethereum", "20190102", {})
    t = read_point_json(spark, os.path.join(root, "*", "*.json"))
    rows = t.orderBy("dt").collect()
    assert [(r["currency"], r["price"]) for r in rows] == [("bitcoin", 3800.0), ("bitcoin", 3801.0)]
    assert rows[1]["market_cap"] is None and rows[0]["extra"] is None
    assert str(rows[0]["dt"]) == "2019-01-01 00:00:00"
    rej = {"/".join(r["_path"].split("/")[-2:]): r
           for r in point_rejects(spark, os.path.join(root, "*", "*.json")).collect()}
    assert rej["bitcoin/20190101.json"]["bad_points"] == 1
    assert rej["ethereum/20190101.json"]["bad_file"] is True


def test_html_table_rows(spark):
    html = """<html><body><table><thead><tr><th>Date</th><th>Open</th><th>High</th><th>Low</th><th>Close</th>
    <th>Volume</th><th>Market Cap</th></tr></thead><tbody>
    <tr><td>Sep 22, 2021</td><td>$1,000.50</td><td>$1,100.00</td><td>$990.10</td><td>$1,050.00</td>
    <td>$12,345,678</td><td>$99,000,000,000</td></tr>
    <tr><td><span>Sep 21, 2021</span></td><td>$900.00</td><td>$1,000.00</td><td>$850.00</td><td>$1,000.50</td>
    <td>$10</td><td>$9</td></tr><tr><td>broken</td></tr></tbody></table></body></html>"""
    pages = spark.createDataFrame([(1, "bitcoin", html)], "page_id long, currency string, html string")
    r = html_table_rows(pages).orderBy("row_no").collect()
    assert len(r) == 2
    assert str(r[0]["day"]) == "2021-09-22" and r[0]["open"] == 1000.5 and r[0]["market_cap"] == 99e9
    assert str(r[1]["day"]) == "2021-09-21" and r[1]["close"] == 1000.5


def test_html_tables_without_end_tags_and_nested(spark):
    from tickweave.sources.html import html_table_rejects, table_cells

    day = lambda d, x: "".join(f"<td>{c}" for c in (d, *[f"${x}.{i}" for i in range(6)]))
    loose = f"<TABLE><tr><th>Date<th>Open<tr>{day('Sep 22, 2021', 1)}<tr class='a'>{day('Sep 21, 2021', 2)}<tr><td>short</table><p>outside</p></table>"
    inner = "<table><tr><td>a<td>b</table>"
    nested = f"<table><tr><td>Sep 20, 2021 {inner}</td>" + "".join(f"<td>${i}.5</td>" for i in range(6)) + f"</tr> stray <tr>{day('never', 3)}</tr></table>"
    broken = "</table></tr><td>no table</td><table><tr><td>1<!-- <td>no --></td><!-- </table> --><td>2"
    pages = spark.createDataFrame([(1, "x", loose), (2, "y", nested), (2, "y", nested), (3, "z", broken), (4, "n", None), (5, "e", "")],
                                  "page_id long, currency string, html string")
    got = sorted((r.page_id, r.row_no, str(r.day), r.open, r.market_cap) for r in html_table_rows(pages).collect())
    second = [(2, 0, "2021-09-20", 0.5, 5.5), (2, 2, "None", 3.0, 3.5)]
    assert got == sorted([(1, 1, "2021-09-22", 1.0, 1.5), (1, 2, "2021-09-21", 2.0, 2.5), *second, *second])
    cells = sorted((r.page_id, r.row_no, r.depth, r.cells) for r in table_cells(pages.filter("page_id in (1, 3)")).collect())
    assert [c for c in cells if c[0] == 3] == [(3, 0, 1, ["1", "2"])]
    assert (1, 3, 1, ["short"]) in cells and (1, 0, 1, []) in cells
    inside = [r.cells for r in table_cells(pages.filter("page_id = 2")).filter("depth = 2").collect()]
    assert inside == [["a", "b"]] * 2
    counts = {r.page_id: (r.rows, r.accepted, r.other_width, r.no_day) for r in html_table_rejects(pages).collect()}
    assert counts == {1: (3, 2, 1, 0), 2: (6, 2, 2, 2), 3: (1, 0, 1, 0)}


def test_driver_pages_have_no_tables(spark):
    from tests.conftest import SF001
    from tickweave.sources import load_table

    pages = load_table(spark, SF001, "pages").withColumn("currency", F.lit("x"))
    assert html_table_rows(pages).count() == 0


def test_incremental_ingest_twice_adds_nothing(spark):
    root, dst, ck = _tmp(), os.path.join(_tmp(), "out"), os.path.join(_tmp(), "ck")
    _write_points(root, "bitcoin", "20190101", {"1546300800": {"v": [1.0, 2.0, 3.0, 4.0, 5.0]}})
    assert ingest_new(spark, root, dst, ck) == 1
    assert spark.read.parquet(dst).count() == 1
    assert ingest_new(spark, root, dst, ck) == 0
    _write_points(root, "bitcoin", "20190102", {"1546387200": {"v": [2.0, 2.0, 3.0, 4.0, 5.0]},
                                                "1546387500": {"v": [3.0, 2.0, 3.0, 4.0, 5.0]}})
    assert ingest_new(spark, root, dst, ck) == 2
    assert spark.read.parquet(dst).count() == 3


def test_result_append_and_window_sink(spark):
    from tickweave.operators import split as SP
    from tickweave.operators import windows as W
    from tickweave.plans import sequence
    from tickweave.sources import write_result, write_windows

    d = _tmp()
    res = spark.createDataFrame([("eth", 0.77), ("zil", -0.05)], "coin string, corr double")
    write_result(res, os.path.join(d, "corr"))
    write_result(res.limit(1), os.path.join(d, "corr"))
    assert spark.read.schema("coin string, corr double").csv(os.path.join(d, "corr")).count() == 3
    s = sequence(make_ticks(spark, [("a", i, i, float(i), 1.0, 2.0) for i in range(60)]), chunks=2)
    w = SP.ordered_split(W.sliding_windows(s, ("price", "volume"), n_in=5, n_out=2), (0.8,), ("train", "test"))
    write_windows(w.drop("pos", "n"), os.path.join(d, "win"))
    back = spark.read.parquet(os.path.join(d, "win"))
    assert back.count() == 54 and {r["split"] for r in back.select("split").distinct().collect()} == {"train", "test"}
    first = back.filter("window_id = 0").first()
    assert [x["price"] for x in first["x"]] == [0.0, 1.0, 2.0, 3.0, 4.0] and first["y"] == [5.0, 6.0]


def test_key_partitioned_sink_prunes_folders(spark):
    from tests.conftest import SF001
    from tickweave.sources.events import ticks_from_events

    d = os.path.join(_tmp(), "by_key")
    write_ticks(ticks_from_events(spark, SF001), d, partition_by_key=True)
    assert sorted(x for x in os.listdir(d) if x.startswith("currency="))[0] == "currency=click"
    back = spark.read.parquet(d).filter(F.col("currency") == "click")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(currency" in plan and "click" in plan
    assert back.count() == ticks_from_events(spark, SF001).filter(F.col("currency") == "click").count()
