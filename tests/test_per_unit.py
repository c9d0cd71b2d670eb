"""Per-unit documents: classification (FLT5), XML parsing (SRC7), enrichment (PRJ11)."""

from __future__ import annotations

from gridmix.functions.taxonomy import A71_NAMESPACE
from gridmix.operators import per_unit

NS = f'xmlns="{A71_NAMESPACE}"'


def doc(*series: str) -> str:
    return f'<?xml version="1.0" encoding="UTF-8"?><GL_MarketDocument {NS}><mRID>x</mRID>{"".join(series)}' \
           f'</GL_MarketDocument>'


def ts(unit="U1", name="Plant", psr="B16", lat="45.5", lon="5.25", periods=None) -> str:
    parts = ["<TimeSeries>"]
    if unit is not None:
        parts.append(f"<registeredResource.mRID codingScheme=\"A01\">{unit}</registeredResource.mRID>")
    if name is not None:
        parts.append(f"<registeredResource.name>{name}</registeredResource.name>")
    if psr is not None:
        parts.append(f"<MktPSRType><psrType>{psr}</psrType></MktPSRType>")
    if lat is not None:
        parts.append(f"<location><latitude>{lat}</latitude><longitude>{lon}</longitude></location>")
    parts.extend(periods if periods is not None else [period()])
    parts.append("</TimeSeries>")
    return "".join(parts)


def period(start="2025-01-01T00:00Z", end="2025-12-31T23:00Z", points=("100",)) -> str:
    inner = []
    if start is not None:
        inner.append(f"<timeInterval.start>{start}</timeInterval.start>")
    if end is not None:
        inner.append(f"<timeInterval.end>{end}</timeInterval.end>")
    for i, q in enumerate(points):
        qty = "" if q is None else f"<quantity>{q}</quantity>"
        inner.append(f"<Point><position>{i + 1}</position>{qty}</Point>")
    return "<Period>" + "".join(inner) + "</Period>"


def parse(spark, bodies, status=200):
    df = spark.createDataFrame([("FR", status, b) for b in bodies], "country_code string, http_status int, body string")
    return per_unit.parse_documents(df).collect()


def test_one_series_one_period_one_point(spark):
    rows = parse(spark, [doc(ts())])
    assert len(rows) == 1
    r = rows[0]
    assert (r.unit_id, r.unit_name, r.psr_type, r.period_start, r.period_end, r.installed_capacity_mw,
            r.latitude, r.longitude) == ("U1", "Plant", "B16", "2025-01-01T00:00Z", "2025-12-31T23:00Z",
                                         100.0, 45.5, 5.25)


def test_point_without_quantity_gives_no_row_and_bad_quantity_null(spark):
    rows = parse(spark, [doc(ts(periods=[period(points=("1", None, "x"))]))])
    assert [r.installed_capacity_mw for r in rows] == [1.0, None]


def test_missing_fields_give_nulls(spark):
    rows = parse(spark, [doc(ts(unit=None, name=None, psr=None, lat=None, periods=[period(start=None, end=None)]))])
    r = rows[0]
    assert (r.unit_id, r.unit_name, r.psr_type, r.latitude, r.period_start, r.period_end) == (None,) * 6


def test_two_periods_and_two_series(spark):
    body = doc(ts(unit="U1", periods=[period(start="2025-01-01T00:00Z"), period(start="2026-01-01T00:00Z")]),
               ts(unit="U2"))
    rows = parse(spark, [body])
    assert sorted((r.unit_id, r.period_start) for r in rows) == [
        ("U1", "2025-01-01T00:00Z"), ("U1", "2026-01-01T00:00Z"), ("U2", "2025-01-01T00:00Z")]


def test_acknowledgement_malformed_and_empty_give_no_rows(spark):
    ack = "<Acknowledgement_MarketDocument><Reason><code>999</code></Reason></Acknowledgement_MarketDocument>"
    malformed = doc(ts())[:150]
    empty = doc()
    assert parse(spark, [ack, malformed, empty]) == []


def test_bad_latitude_is_null_not_an_error(spark):
    rows = parse(spark, [doc(ts(lat="north"))])
    assert rows[0].latitude is None and rows[0].longitude == 5.25


def test_ingest_responses_classifies_then_enriches(spark):
    bodies = [("FR", 200, doc(ts(psr="B14"))), ("FR", 503, doc(ts())), ("BE", 200, "<html>busy</html>"),
              ("BE", 200, doc(ts(psr=None)))]
    df = spark.createDataFrame(bodies, "country_code string, http_status int, body string")
    rows = per_unit.ingest_responses(df, "2026-01-01 00:00:00").collect()
    got = sorted((r.country_code, r.energy_type, r.is_renewable, r.document_type) for r in rows)
    assert got == [("BE", "Unknown (None)", False, "A71"), ("FR", "Nuclear", False, "A71")]


def test_response_outcomes(spark):
    bodies = [("FR", 200, doc(ts(periods=[period(points=("1", "2", None))]))), ("FR", 503, doc(ts())),
              ("BE", 200, doc(ts())[:120]), ("BE", 200, "<Acknowledgement_MarketDocument/>")]
    df = spark.createDataFrame(bodies, "country_code string, http_status int, body string")
    got = sorted((r.response_class, r.status, r.rows) for r in per_unit.response_outcomes(df).collect())
    assert got == [("data", "failed", 0), ("data", "success", 2), ("failed", "failed", 0),
                   ("no_data", "failed", 0)]


def test_series_reader_splits_documents_by_element(spark, tmp_path):
    import os

    from gridmix.sources import landing

    root = tmp_path / "responses"
    files = {("FR", "big.xml"): doc(ts(unit="U1"), ts(unit="U2", periods=[period(points=("1", "2"))])),
             ("FR", "failed.xml"): doc(ts(unit="U9")),
             ("BE", "ack.xml"): "<Acknowledgement_MarketDocument><x/></Acknowledgement_MarketDocument>"}
    for (country, name), body in files.items():
        os.makedirs(root / f"country_code={country}", exist_ok=True)
        (root / f"country_code={country}" / name).write_text(body)
    manifest = spark.createDataFrame([("failed.xml", 503)], "file_name string, http_status int")
    series = landing.read_series(spark, str(root), manifest)
    rows = per_unit.series_rows(series).collect()
    assert sorted((r.country_code, r.unit_id, r.installed_capacity_mw) for r in rows) == [
        ("FR", "U1", 100.0), ("FR", "U2", 1.0), ("FR", "U2", 2.0)]


def test_series_reader_keeps_complete_series_of_truncated_file(spark, tmp_path):
    import os

    from gridmix.sources import landing

    root = tmp_path / "responses"
    os.makedirs(root / "country_code=FR")
    body = doc(ts(unit="U1"), ts(unit="U2"))
    cut = body.index("<TimeSeries>", body.index("U1")) + 40   # inside the second series
    (root / "country_code=FR" / "cut.xml").write_text(body[:cut])
    rows = per_unit.series_rows(landing.read_series(spark, str(root))).collect()
    assert [r.unit_id for r in rows] == ["U1"]
    responses = spark.createDataFrame([("FR", 200, body[:cut])], "country_code string, http_status int, body string")
    assert per_unit.parse_documents(responses).count() == 0   # the per-document path drops the whole document


def test_pretty_printed_document_with_attributes(spark):
    body = f"""<?xml version="1.0" encoding="UTF-8"?>
<GL_MarketDocument {NS}>
    <mRID>abc</mRID>
    <TimeSeries>
        <registeredResource.mRID codingScheme="A01">
            17W100P100P0344D
        </registeredResource.mRID>
        <registeredResource.name>Plant one</registeredResource.name>
        <MktPSRType>
            <psrType>B14</psrType>
        </MktPSRType>
        <Period>
            <timeInterval.start>2025-01-01T00:00Z</timeInterval.start>
            <timeInterval.end>2025-12-31T23:00Z</timeInterval.end>
            <resolution>P1Y</resolution>
            <Point>
                <position>1</position>
                <quantity unit="MAW"> 1250.5 </quantity>
            </Point>
        </Period>
    </TimeSeries>
</GL_MarketDocument>
"""
    r = parse(spark, [body])[0]
    assert (r.unit_id, r.unit_name, r.psr_type, r.period_start, r.installed_capacity_mw) == (
        "17W100P100P0344D", "Plant one", "B14", "2025-01-01T00:00Z", 1250.5)


def test_prefixed_namespace_document(spark):
    body = (f'<ns:GL_MarketDocument xmlns:ns="{A71_NAMESPACE}"><ns:TimeSeries>'
            '<ns:registeredResource.mRID>U1</ns:registeredResource.mRID><ns:Period>'
            '<ns:timeInterval.start>2025-01-01T00:00Z</ns:timeInterval.start>'
            '<ns:Point><ns:quantity>5</ns:quantity></ns:Point></ns:Period></ns:TimeSeries></ns:GL_MarketDocument>')
    rows = parse(spark, [body])
    assert [(r.unit_id, r.installed_capacity_mw) for r in rows] == [("U1", 5.0)]


def test_first_of_repeated_elements_and_numbers(spark):
    body = ('<GL_MarketDocument xmlns="urn:iec62325.351:tc57wg16:451-6:configurationdocument:3:0"><TimeSeries>'
            "<registeredResource.mRID> U 1 </registeredResource.mRID><registeredResource.name>first</registeredResource.name>"
            "<registeredResource.name>second</registeredResource.name><Period><timeInterval.start>s</timeInterval.start>"
            "<Point><quantity>5</quantity><quantity>6</quantity></Point><Point><quantity>12d</quantity></Point>"
            "<Point><quantity> 1e3 </quantity></Point><Point><quantity>NaN</quantity></Point></Period></TimeSeries></GL_MarketDocument>")
    df = spark.createDataFrame([("FR", body)], "country_code string, body string")
    rows = per_unit.parse_documents(df).collect()
    assert [(r.unit_id, r.unit_name, r.installed_capacity_mw) for r in rows] == [
        ("U 1", "first", 5.0), ("U 1", "first", None), ("U 1", "first", 1000.0), ("U 1", "first", None)]


def test_series_periods_and_points_at_any_depth(spark):
    deep = doc("<Units a='x>y'><Unit>" + ts(periods=["<Extra>" + period(points=("1", "2")) + "</Extra>", "<Extra><More>" + period(points=("3",)) + "</More></Extra>"])
               + "</Unit></Units>", ts(unit="U2", periods=[period(points=("4",))]))
    prefixed = deep.replace("<TimeSeries>", "<ns:TimeSeries id=\"1\">").replace("</TimeSeries>", "</ns:TimeSeries>").replace(
        f"<GL_MarketDocument {NS}>", f'<GL_MarketDocument xmlns="{A71_NAMESPACE}" xmlns:ns="{A71_NAMESPACE}">')
    df = lambda bodies: spark.createDataFrame([("FR", 200, b) for b in bodies], "country_code string, http_status int, body string")
    for body in (deep, prefixed):
        rows = per_unit.parse_nested(df([body])).collect()
        assert sorted((r.unit_id, r.installed_capacity_mw, r.latitude, r.period_end) for r in rows) == [
            ("U1", 1.0, 45.5, "2025-12-31T23:00Z"), ("U1", 2.0, 45.5, "2025-12-31T23:00Z"), ("U1", 3.0, 45.5, "2025-12-31T23:00Z"),
            ("U2", 4.0, 45.5, "2025-12-31T23:00Z")]
    assert per_unit.parse_nested(df([deep[:-30], deep.replace("</Unit>", "", 1), "<Acknowledgement_MarketDocument/>", "", None])).collect() == []
    flat = [doc(ts(), ts(unit="U3", periods=[period(points=("5", None, "x"))])), doc(ts(periods=[]))]
    assert sorted(map(str, per_unit.parse_nested(df(flat)).collect())) == sorted(map(str, per_unit.parse_documents(df(flat)).collect()))
    counted = {r.body: r.n_rows for r in per_unit.with_series(df([deep, *flat])).collect()}
    assert counted == {deep: 4, flat[0]: 3, flat[1]: 0}


def test_complete_series_files_only(spark, tmp_path):
    from gridmix.sources import landing

    for name, body in (("whole.xml", doc(ts(), ts(unit="U2"))), ("cut.xml", doc(ts(unit="U9"), ts())[:-10])):
        folder = tmp_path / "country_code=FR"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(body)
    rows = per_unit.series_rows(landing.read_series(spark, str(tmp_path), complete_only=True)).collect()
    assert sorted(r.unit_id for r in rows) == ["U1", "U2"]
    per_document = per_unit.parse_documents(landing.read_responses(spark, str(tmp_path))).collect()
    assert sorted(map(str, rows)) == sorted(map(str, per_document))
    assert "U9" in {r.unit_id for r in per_unit.series_rows(landing.read_series(spark, str(tmp_path))).collect()}


def test_a_document_is_parsed_where_its_series_are_made_only(spark, capsys):
    df = spark.createDataFrame([("FR", 200, doc(ts()))], "country_code string, http_status int, body string")
    for parse, times in ((per_unit.parse_documents, 1), (per_unit.parse_nested, 2)):  # as it is, and without wrappers
        capsys.readouterr()
        parse(df).explain()
        assert capsys.readouterr().out.count("from_xml(") == times
        assert [r.unit_id for r in parse(df).collect()] == ["U1"]


def test_tags_with_attributes_and_loose_quotes(spark):
    bodies = ["""<a:Unit x="1>2" y='<b>'><ns:quantity u='>' />""", """<Unit x="1>2><quantity>1</quantity>""", "a < b <Points><Point\n/><x-1/></Points>"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert [r[0] for r in df.select(per_unit.unwrapped(per_unit.F.col("body"))).collect()] == [
        f"<document>{x}</document>" for x in ("<quantity/>", """<Unit x="1>2><quantity>1</quantity>""", "a < b <Point/>")]


def test_landed_texts_are_written_without_being_sorted(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from gridmix.sources import fixtures, landing
    from tests.conftest import SF_SMALL

    key, seen, text = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.text
    before = spark.conf.get(key)

    def watched(self, path, **options):
        seen.append((int(spark.conf.get(key)), self._df._jdf.queryExecution().optimizedPlan().toString()))
        return text(self, path, **options)

    monkeypatch.setattr(DataFrameWriter, "text", watched)
    landing.land_responses(spark.createDataFrame([("FR", 200, "a\nb"), (None, 503, "c")], "country_code string, http_status int, body string"), str(tmp_path / "r"))
    assert sorted((r.country_code, r.http_status, r.body) for r in landing.read_responses(spark, str(tmp_path / "r"), one_per_line=True).fillna("").collect()) == [
        ("", 503, "c"), ("FR", 200, "a b")]
    fixtures.land_a71_files(spark, SF_SMALL, str(tmp_path / "s"))
    assert all(files >= 36 for files, _ in seen) and len(seen) == 2 and spark.conf.get(key) == before
    assert "<TimeSeries>" in seen[1][1] and "<TimeSeries>" not in seen[1][1].split("Sort [", 1)[1]  # texts are built above the sort
    for file in (tmp_path / "s").rglob("part-*.txt"):
        lines = file.read_text().splitlines()
        assert lines[0].startswith("<?xml") and all(x.startswith("<TimeSeries>") for x in lines[1:-1])
        assert (lines[-1] == "</GL_MarketDocument>") is not str(file.parent).endswith("country_code=FR/part=3")


def test_wrappers_go_in_one_pass_and_orders_are_gathered_as_rows(spark, capsys, tmp_path):
    from datetime import datetime

    from gridmix.sources import fixtures

    series = ["<n:Unit a='>'><TimeSeries><!-- <quantity>0</quantity> --><ns:Period\n x=\"1>2\"><Points><Point>"
              "<a.b:quantity >5</a.b:quantity ><quantity/></Point></Points></ns:Period></TimeSeries></n:Unit>",
              "<TimeSeries><Period><Point><quantity>1</quantity></Point><Step><Point><n:quantity>2</n:quantity></Point></Step></Period></TimeSeries>",
              "<Unit><TimeSeries><Period><Point><quantity>3</quantity></Point></Period></TimeSeries>"]  # not well-formed
    df = spark.createDataFrame([("FR", 200, doc(s)) for s in series], "country_code string, http_status int, body string")
    assert df.select(per_unit.unwrapped(per_unit.F.col("body"))).first()[0] == (
        "<document>x<TimeSeries><Period><Point><quantity>5</quantity><quantity/></Point></Period></TimeSeries></document>")
    assert sorted(r.installed_capacity_mw for r in per_unit.parse_nested(df).collect()) == [1.0, 2.0, 5.0]
    capsys.readouterr()
    per_unit.parse_nested(df).explain()
    assert capsys.readouterr().out.count("regexp_replace(") == 1
    # an order's lines are gathered as table rows, the texts are built above
    at = datetime(2024, 1, 2)
    lines = [(1, 9, 1, 5.0, 2.0, 0.5, at), (1, 9, 2, 6.0, 3.0, 0.25, at), (1, 18, 2, None, 3.0, 0.25, at), (2, None, 1, 1.0, 1.0, 1.0, at)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_partkey long, l_extendedprice double, l_quantity double, l_discount double, "
                          "l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    nested = fixtures.a71_nested_responses(spark, str(tmp_path))
    plan = nested._jdf.queryExecution().optimizedPlan().toString()
    assert "<TimeSeries>" in plan and "<TimeSeries>" not in plan.split("Aggregate [", 1)[1].split("\n", 1)[1] and "collect_list(struct(" in plan
    assert sorted(r.body.count("<TimeSeries>") for r in nested.collect()) == [0, 2]
    assert sorted(r.installed_capacity_mw for r in per_unit.parse_nested(nested).collect()) == [0.25, 0.5, 2.0, 3.0, 5.0, 6.0]


def test_large_series_files_are_landed_compressed(spark, tmp_path):
    import gzip
    from datetime import datetime

    from gridmix.sources import fixtures, landing

    at = datetime(2024, 1, 2)
    lines = [(k, 4 + 9 * (k % 7) + (k % 3 == 0), k % 30, float(k), at) for k in range(4000)]  # FR and IT
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_partkey long, l_extendedprice double, l_shipdate timestamp").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    root = tmp_path / "landed"
    fixtures.land_a71_files(spark, str(tmp_path), str(root))
    files = [p for p in root.rglob("part-*")]
    texts = {p: gzip.decompress(p.read_bytes()).decode() for p in files}
    assert len(files) == len({p.parent for p in files}) and 8 * sum(p.stat().st_size for p in files) < sum(map(len, texts.values()))
    n = 0
    for file, text in texts.items():
        whole = not str(file.parent).endswith("country_code=FR/part=3")
        first, *series, last = text.splitlines() if whole else [*text.splitlines(), "</GL_MarketDocument>"]
        assert first.startswith("<?xml") and all(x.startswith("<TimeSeries>") and x.endswith("</TimeSeries>") for x in series)
        assert last == "</GL_MarketDocument>" and whole is ("</GL_MarketDocument>" in text)
        n += len(series) if whole else 0
    assert per_unit.series_rows(landing.read_series(spark, str(root), complete_only=True)).count() == n < len(lines)
