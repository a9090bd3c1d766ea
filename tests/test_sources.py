import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlark.sources import readers, sinks

META = """<archive xmlns="http://rs.tdwg.org/dwc/text/"><core fieldsTerminatedBy="\\t" fieldsEnclosedBy="" ignoreHeaderLines="1" rowType="http://x/Occurrence"><files><location>occurrence.txt</location></files>
<id index="0"/><field index="1" term="http://x/species"/><field term="http://x/country" default="XA"/></core></archive>"""


@pytest.fixture
def archive(tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("meta.xml", META)
        z.writestr("occurrence.txt", 'id\tspecies\n1\t"A b\n2\tNULL\n')
    return path


def test_archive(spark, archive, tmp_path):
    (m,) = readers.inspect_archive(str(archive))
    assert (m.location, m.separator, m.fields, m.constants) == ("occurrence.txt", "\t", ("id", "species"), (("country", "XA"),))
    rows, bad = readers.load_archive_member(spark, str(archive), str(tmp_path), constants={"snapshot": "s1"})
    assert sorted(map(tuple, rows.select("id", "species", "country", "snapshot").collect())) == [("1", '"A b', "XA", "s1"), ("2", None, "XA", "s1")] and bad.count() == 0
    numbered, _ = readers.load_archive_member(spark, str(archive), str(tmp_path), row_number="n")
    assert sorted((r["n"], r["id"]) for r in numbered.collect()) == [(1, "1"), (2, "2")]


def test_a_member_with_broken_lines(spark, tmp_path):
    """Two header lines, short, long, badly quoted and empty lines: every line comes out once."""
    meta = META.replace('fieldsEnclosedBy=""', 'fieldsEnclosedBy="&quot;"').replace('ignoreHeaderLines="1"', 'ignoreHeaderLines="2"')
    lines = ["id\tspecies", "# second header", '1\t"x ""y"" z"', "2", "3\ta\tb", '4\t"open', "", '5\t"t\tu"', "id\tspecies"]
    path = tmp_path / "b.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("meta.xml", meta)
        z.writestr("occurrence.txt", "\n".join(lines) + "\n")
    rows, bad = readers.load_archive_member(spark, str(path), str(tmp_path), row_number="n")
    assert sorted((r["n"], r["id"], r["species"]) for r in rows.collect()) == [(1, "1", 'x "y" z'), (6, "5", "t\tu"), (7, "id", "species")]
    assert sorted((r["n"], r["line"], *r["errors"]) for r in bad.collect()) == [(2, "2", "line:field_count"), (3, "3\ta\tb", "line:field_count"), (4, '4\t"open', "line:quoting"), (5, "", "line:field_count")]


def test_headers_of_many_files_and_blocks(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.txt").write_text("h\n" + "".join(f"{k}-{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows, bad = readers.load_delimited(spark, str(tmp_path), readers.text_contract(["v"]), 1)
        assert rows.select("v").distinct().count() == rows.count() == 15_000 and bad.count() == 0 and rows.where("v = 'h'").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_workload(spark, tmp_path):
    p = tmp_path / "w.jsonl"
    p.write_text('{"a": 1, "b": "x"}\n{"a": 2}\n')
    assert readers.read_workload(spark, str(p), ["b", "c"]).columns == ["b", "c"]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<script type="application/ld+json">{"@type":"ImageObject","contentUrl":"/a.jpg"}</script><img src="b.jpg">', ["https://h/a.jpg"]),
        ('<meta property="og:image" content="x.png"><img src="b.jpg">', ["https://h/p/x.png"]),
        ('<img src="b.jpg"><img src="b.jpg"><img src="data:x">', ["https://h/p/b.jpg"]),
        ('<script type="application/ld+json">{broken</script>', []),
        (None, []),
    ],
)
def test_page_images(html, want):
    assert readers.image_candidates(html, "https://h/p/") == want


def test_publish(spark, tmp_path):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    path = str(tmp_path / "t")
    manifest = sinks.publish(df, path, {"even": F.col("x") % 2 == 0}, 10, ["id"], {"by": "test"})
    assert manifest["rows"] == 10 and json.loads((tmp_path / "t" / "manifest.json").read_text())["by"] == "test"
    assert spark.read.parquet(f"{path}/data").count() == 10
    with pytest.raises(FileExistsError):
        sinks.publish(df, path)
    with pytest.raises(ValueError, match="odd"):
        sinks.publish(df, str(tmp_path / "u"), {"odd": F.col("x") % 2 == 1})
    assert not (tmp_path / "u").exists() and not (tmp_path / "u.staging").exists()


def test_conform_and_partitions(spark, tmp_path):
    schema = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("n", T.DateType())])
    df = spark.createDataFrame([("1", 5), ("x", 6)], "b string, A int")
    assert [tuple(r) for r in sinks.conform(df, schema).collect()] == [(1, "5", None), (None, "6", None)]
    sinks.write_by_hash(spark.range(50), str(tmp_path / "h"), "id", 4)
    sinks.write_by_range(spark.range(50), str(tmp_path / "r"), "id", 20)
    assert spark.read.parquet(str(tmp_path / "h")).count() == 50
    assert spark.read.parquet(str(tmp_path / "r")).groupBy("source_partition").count().count() == 3
    sinks.write_csv(spark.createDataFrame([("=1", 1)], "a string, b int"), str(tmp_path / "c"))
    assert "'=1" in "".join(p.read_text() for p in (tmp_path / "c").glob("*.csv"))


def test_bundle_and_inventory(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "a.txt").write_text("x")
    made = sinks.bundle(str(folder), str(tmp_path / "b.tgz"))
    assert sinks.unbundle(str(tmp_path / "b.tgz"), str(tmp_path / "g")) == made and (tmp_path / "g" / "a.txt").read_text() == "x"
    row = readers.inventory(spark, [str(folder)]).first()
    assert row["n_bytes"] == 1 and row["digest"] == "sha256:" + made["a.txt"]["sha256"]


def test_image_hash(spark):
    import numpy as np

    from fieldlark.functions.images import difference_hash, grey_hash

    ramp = np.tile(np.arange(64), (64, 1))
    assert difference_hash(ramp) == "dhash128-v1:" + "f" * 16 + "0" * 16
    rng = np.random.default_rng(0)
    noise = rng.integers(0, 255, (120, 160)).astype(np.uint8)
    near = np.clip(noise.astype(int) + 3, 0, 255)
    apart = int(difference_hash(noise)[12:], 16) ^ int(difference_hash(near)[12:], 16)
    assert apart.bit_count() <= 8
    df = spark.createDataFrame([(bytearray(noise.tobytes()), 160), (None, 5), (bytearray(b"abc"), 2)], "p binary, w int")
    assert [r[0] for r in df.select(grey_hash("p", "w")).collect()] == [difference_hash(noise), None, None]


def test_paged_source(spark, tmp_path):
    from fieldlark.sources.pages import PagedJson

    pages = tmp_path / "pages"
    pages.mkdir()
    for i, body in enumerate([{"response": {"results": [{"k": 1}, {"k": 2}], "endOfRecords": False}}, {"results": [{"k": 3}], "endOfRecords": True}, {"results": None}]):
        (pages / f"p{i}.json").write_text(json.dumps(body))
    spark.dataSource.register(PagedJson)
    rows = spark.read.format("paged_json").load(str(pages)).orderBy("page", "place").collect()
    assert [(r["page"], r["place"], r["record"], r["end_of_records"]) for r in rows] == [(0, 0, '{"k": 1}', False), (0, 1, '{"k": 2}', False), (1, 0, '{"k": 3}', True)]
    out = []

    def each(batch, n):
        out.extend(r["record"] for r in batch.collect())

    stream = spark.readStream.format("paged_json").option("pagesPerBatch", 1).load(str(pages))
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
    for _ in range(60):
        q.processAllAvailable()
        if len(out) >= 3:
            break
    q.stop()
    assert sorted(out) == ['{"k": 1}', '{"k": 2}', '{"k": 3}']
