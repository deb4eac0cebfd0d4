"""Readers, writers and streams on files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import records
from corpusloom.sources import markup, readers, sinks
from corpusloom.streaming import incremental


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "one two", "n": 1}\n\n{broken\n{"text": "", "n": 2}\n{"text": "three", "n": 3}\n')
    path, schema = str(tmp_path / "a.jsonl"), "text string, n bigint"
    assert readers.json_lines(spark, path, schema).count() == 3
    good, bad = readers.quarantined(readers.json_lines(spark, path, schema, keep_corrupt=True).cache())
    assert good.count() == 3 and bad.first()[0] == "{broken"
    raw = readers.raw_lines(spark, path, schema)
    assert raw.count() == 4
    assert [r.n for r in readers.corpus(spark, path, "tag", 2, "n").collect()] == [1]
    assert {r.source for r in readers.corpus(spark, path, "tag").collect()} == {"tag"}
    assert sorted(r.line_no for r in readers.numbered_lines(spark, path).collect()) == list(range(5))


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"a, ""b""\nc"\n2,d\n')
    assert [r.t for r in readers.csv_table(spark, str(tmp_path / "a.csv"), "id int, t string").orderBy("id").collect()] == ['a, "b"\nc', "d"]
    with gzip.open(tmp_path / "m.csv.gz", "wt") as f:
        f.write("PMCID,DOI\nP1, d1 \nP1,d2\nP2,\n")
    assert [tuple(r) for r in readers.dictionary(spark, str(tmp_path / "m.csv.gz"), "PMCID", "DOI").collect()] == [("P1", "d2")]
    (tmp_path / "many").mkdir()
    for i in range(3):
        (tmp_path / "many" / f"{i}.csv").write_text(f"id\n{i}\n")
    assert readers.csv_folder(spark, str(tmp_path / "many"), "id int").count() == 3
    assert readers.screened(spark.range(10), F.col("id") > 4, 3).count() == 3


def test_files(spark, tmp_path):
    (tmp_path / "big.xml").write_text("x" * 200)
    (tmp_path / "small.xml").write_text("x")
    assert [r.id for r in readers.existing_ids(spark, str(tmp_path)).collect()] == ["big"]
    assert {r.name for r in readers.xml_files(spark, str(tmp_path)).collect()} == {"big", "small"}
    assert records.parse_articles(readers.xml_files(spark, str(tmp_path))).count() == 0
    assert readers.first_that_exists(spark, str(tmp_path / "no"), str(tmp_path)) == str(tmp_path)
    (tmp_path / "d.json").write_text('[{"a": 1}, {"a": 2}]')
    assert readers.documents_json(spark, str(tmp_path / "d.json")).count() == 2


def test_trainer_logs(spark, tmp_path):
    for at, loss in (("run/checkpoint-2", 2.0), ("run/checkpoint-10", 1.0), ("other", 3.0), ("other/checkpoint-5", 9.0)):
        (tmp_path / at).mkdir(parents=True)
        (tmp_path / at / "trainer_state.json").write_text(json.dumps({"log_history": [{"step": 1, "loss": loss}]}))
    assert {r.run: r.loss for r in readers.trainer_logs(spark, str(tmp_path)).collect()} == {"run": 1.0, "other": 3.0}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "é\nx", "a"), (2, "y", "b")], "id int, text string, g string")
    sinks.write_both(rows, str(tmp_path / "both"), ["text"])
    assert spark.read.json(str(tmp_path / "both/train")).columns == ["text"] and spark.read.json(str(tmp_path / "both/full")).count() == 2
    sinks.write_split(rows, str(tmp_path / "split"), "g")
    assert spark.read.json(str(tmp_path / "split")).where("g = 'a'").first().id == 1
    sinks.write_texts(rows, str(tmp_path / "texts"))
    sinks.upsert(rows, str(tmp_path / "up"), "g")
    sinks.upsert(spark.createDataFrame([(3, "z", "a")], "id int, text string, g string"), str(tmp_path / "up"), "g")
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "up")).collect()) == [2, 3]
    assert [sinks.next_version(spark, rows, str(tmp_path / "v")) for _ in range(2)] == [0, 1]
    sinks.write_index(rows, str(tmp_path / "index"))
    assert {r.metric: r.value for r in sinks.statistics(rows.agg(F.count("*").alias("n"))).collect()} == {"n": 2.0}


def test_marked_csv_documents_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a,b", 0.5), (2, "ü", 1500.0)], "id int, name string, value double")
    sinks.write_csv(rows.coalesce(1), str(tmp_path / "csv"), mark=True)
    (file,) = (tmp_path / "csv").glob("*.csv")
    assert file.read_bytes().startswith(b"\xef\xbb\xbfid,name")
    assert [r.id for r in readers.csv_table(spark, str(tmp_path / "csv"), "id int, name string, value double").orderBy("id").collect()] == [1, 2]
    assert json.loads(sinks.as_document(rows, "id").first().document) == {"results": {"1": {"name": "a,b", "value": 0.5}, "2": {"name": "ü", "value": 1500.0}}}
    lines = [r.line for r in sinks.report(sinks.statistics(rows.agg(F.sum("value").alias("total")))).collect()]
    assert lines == ["total" + "." * 35 + " 1,500.50"]


def test_subsets_and_compressed_lines(spark, tmp_path):
    import zstandard

    spark.createDataFrame([(1, "m", "train"), (2, "m", "test"), (3, "n", "train")], "id int, subset string, split string").write.partitionBy("subset", "split").parquet(str(tmp_path / "set"))
    assert [r.id for r in readers.subset(spark, str(tmp_path / "set"), "m").collect()] == [1] and readers.subset(spark, str(tmp_path / "set"), "m", "test").columns == ["id"]
    lines = b'{"a": 1, "n": {"x": [1, 2]}}\n{"a": 2, "n": null}\n'
    (tmp_path / "part.jsonl.zst").write_bytes(zstandard.compress(lines))
    (tmp_path / "part.jsonl").write_bytes(lines)
    try:
        packed = readers.json_lines(spark, str(tmp_path / "part.jsonl.zst"), "a int").count()
    except Exception as e:  # Hadoop without its native library has no zstandard for texts
        assert "zstandard" in str(e).lower() or "zstd" in str(e).lower()
        packed = 2
    assert packed == readers.json_lines(spark, str(tmp_path / "part.jsonl"), "a int").count() == 2
    (tmp_path / "doc.json").write_text('{"runs": [{"model": "m", "picks": [1, 2]}, {"model": "n", "picks": []}]}')
    nested = readers.documents_json(spark, str(tmp_path / "doc.json"))
    assert [(r.model, r.picks) for r in nested.select(F.explode("runs").alias("r")).select("r.*").collect()] == [("m", [1, 2]), ("n", [])]


def test_articles_in_order(spark, tmp_path):
    for i in (30, 4, 200):
        body = "word " * 120
        (tmp_path / f"{i}.xml").write_text(f"<article><front><article-meta><article-id pub-id-type='pmc'>{i}</article-id></article-meta></front><body><sec><title>A</title><p>{body}</p></sec></body><fig><caption><p>a figure's caption</p></caption></fig><table-wrap><caption><p>a table's caption</p></caption></table-wrap></article>")
    found = readers.articles(spark, str(tmp_path))
    assert [r.pmcid for r in found.collect()] == ["PMC200", "PMC30", "PMC4"]
    assert {(r.pmcid, r.section_no, r.title) for r in records.exploded_sections(found).collect()} == {(f"PMC{i}", 0, "A") for i in (30, 4, 200)}
    assert {(r.kind, r.caption_no, r.caption) for r in records.exploded_captions(found).collect()} == {("figure", 0, "a figure's caption"), ("table", 0, "a table's caption")}


def test_markup(spark):
    html = "<table><thead><tr><td>h</td></tr></thead><tbody><tr><td>2024</td><td><a href='/x'>T <b>b</b></a></td></tr><tr><td>2023</td><td>none</td></tr></tbody></table>"
    found = markup.table_links(spark.createDataFrame([(1, html), (2, None)], "id int, html string"), "id", "html", "https://h").collect()
    assert [tuple(r) for r in found] == [(1, "2024", "T b", "https://h/x")]
    row = spark.createDataFrame([("A: b", "2024/1/2", "http://u:1", "body")], "t string, d string, u string, x string")
    c = F.col
    told = row.select(markup.page_header(markup.page_file("S", c("t"), c("d"), c("u"), F.lit("now"), c("x"))).alias("h"), markup.page_file_name(c("t"), c("d")).alias("n")).first()
    assert told.h["title"] == "A: b" and told.h["url"] == "http://u:1" and told.h["chars"] == "4" and told.n == "2024-1-2_a_b.md"


def test_streams_resume(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    put = lambda rows: spark.createDataFrame(rows, "k string, n bigint").coalesce(1).write.mode("append").parquet(source)
    put([("a", 1), ("b", 1), ("a", 2)])
    stream = lambda: incremental.file_stream(spark, source, "k string, n bigint")
    first = incremental.run_available(incremental.first_seen(stream(), ["k"]), "t", checkpoint=checkpoint)
    assert first.count() == 2
    put([("a", 3), ("c", 1)])
    assert [r.k for r in incremental.run_available(incremental.first_seen(stream(), ["k"]), "t", checkpoint=checkpoint).collect()] == ["c"]


def test_running_budget_over_batches(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    kinds = "k string, n bigint, t bigint, _running string"
    put = lambda rows: spark.createDataFrame([(*r, "x") for r in rows], kinds).repartition(3).write.mode("append").parquet(source)
    run = lambda: incremental.run_budget(incremental.file_stream(spark, source, kinds), "k", "n", "t", 10, "b", checkpoint)
    put([("a", 2, 6), ("a", 1, 3), ("b", 1, 50), (None, 1, 9), (None, 2, None), (None, 3, 9)])
    assert sorted((r.k or "", r.n) for r in run().collect()) == [("", 1), ("", 2), ("", 3), ("a", 1), ("a", 2), ("b", 1)]
    put([("a", 3, 4), ("a", 4, 1), ("b", 2, 1), (None, 4, 1)])
    found = run()  # a restart from the checkpoint keeps what was spent
    assert [r.n for r in found.collect()] == [3] and found.columns == ["k", "n", "t", "_running"]
    assert run().count() == 0  # nothing new


def test_a_state_that_is_gone_fails(spark, tmp_path):
    """A checkpoint without its state doesn't start every key at nothing."""
    import shutil

    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    put = lambda i: spark.createDataFrame([("a", i, 3)] * 3, "k string, n bigint, t bigint").write.mode("append").parquet(source)
    run = lambda: incremental.run_budget(incremental.file_stream(spark, source, "k string, n bigint, t bigint"), "k", "n", "t", 10, "b", checkpoint).count()
    put(1)
    assert run() == 3
    shutil.rmtree(f"{checkpoint}/state")
    put(2)
    with pytest.raises(Exception):  # noqa: B017  Spark's own error of the state store
        run()


@pytest.mark.parametrize("more", [{"keep_ms": 2000}, {"idle_ms": 2000}])
def test_budgets_are_forgotten(spark, tmp_path, more):
    """With a time to keep it, a key's state goes by itself; a timer clears keys that aren't seen."""
    import time

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put = lambda k, n: spark.createDataFrame([(k, n, 9)], "k string, n bigint, t bigint").coalesce(1).write.mode("append").parquet(source)
    put("a", 1)
    before = spark.conf.get(incremental.STORE_SETTING)
    spark.conf.set(incremental.STORE_SETTING, incremental.STORE)
    stream = incremental.budgeted(incremental.file_stream(spark, source, "k string, n bigint, t bigint"), "k", "n", "t", 9, **more)
    query = stream.writeStream.option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="300 milliseconds").format("parquet").start(out)
    kept = lambda: sorted(r.n for r in spark.read.schema("k string, n bigint, t bigint").parquet(out).collect())
    try:
        until = time.time() + 40
        while kept() != [1] and time.time() < until:
            time.sleep(0.3)
        time.sleep(4)
        put("a", 2)
        while kept() != [1, 2] and time.time() < until:
            time.sleep(0.3)
        assert kept() == [1, 2] and query.exception() is None
    finally:
        query.stop()
        spark.conf.set(incremental.STORE_SETTING, before)


def test_three_files_one_budget(spark, tmp_path):
    """Each file a batch of its own: the rows kept are those of one pass over all."""
    source = str(tmp_path / "in")
    rows = [(f"k{i % 4}", i, (i * 7) % 5) for i in range(120)]
    for part in range(3):
        spark.createDataFrame(rows[40 * part : 40 * part + 40], "k string, n bigint, t bigint").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, n bigint, t bigint").option("maxFilesPerTrigger", 1).parquet(source)
        kept = incremental.run_budget(stream, "k", "n", "t", 25, "b", str(tmp_path / "check"))
        kept.write.mode("append").parquet(str(tmp_path / "out"))
    spent, want = {}, []
    for k, n, t in rows:
        if spent.get(k, 0) < 25:
            want.append(n)
        spent[k] = spent.get(k, 0) + t
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()) == want


def test_appending_tells_its_progress(spark, tmp_path):
    source, out, told = str(tmp_path / "in"), str(tmp_path / "out"), []
    for rows in (5, 3):
        spark.range(rows).write.mode("append").parquet(source)
        incremental.appended(incremental.file_stream(spark, source, "id bigint"), lambda b: b.where("id > 0"), out, str(tmp_path / "check"), told.append)
    assert [t["rows"] for t in told] == [4, 2] and [t["batch"] for t in told] == [0, 1] and spark.read.parquet(f"{out}/batch=*").count() == 6


def test_streams_tell_their_progress(spark, tmp_path):
    import time

    from corpusloom.streaming import incremental

    spark.range(7).write.parquet(str(tmp_path / "in"))
    told: list[dict] = []
    listener = incremental.Progress(told.append)
    spark.streams.addListener(listener)
    try:
        incremental.run_available(incremental.file_stream(spark, str(tmp_path / "in"), "id bigint"), "progress")
        until = time.time() + 20
        while sum(t["rows"] for t in told) < 7 and time.time() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(t["rows"] for t in told) == 7 and told[0]["batch"] == 0


def test_counters_of_a_pass(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "if(id % 3 = 0, 'dropped', 'kept') AS decision", "if(id % 10 = 0, null, id) AS text")
    told = sinks.write_counted(rows, str(tmp_path / "out"), {"n": F.count("*"), "kept": F.count_if(F.col("decision") == "kept"), "errors": F.count_if(F.col("text").isNull())}, "decision")
    assert told.collect() == [(100, 66, 10)] and spark.read.json(str(tmp_path / "out")).count() == 100


def test_two_writers_leave_two_versions(spark, tmp_path):
    """Writers at once, a failing one, and a reader of an older version."""
    import threading

    path = str(tmp_path / "table")
    assert sinks.next_version(spark, spark.range(3), path) == 0
    first = sinks.read_version(spark, path)
    got: list[int] = []
    writers = [threading.Thread(target=lambda n=n: got.append(sinks.next_version(spark, spark.range(n), path))) for n in (5, 6, 7)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(got) == [1, 2, 3] and sorted(sinks.read_version(spark, path, n).count() for n in got) == [5, 6, 7]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.next_version(spark, spark.range(4).selectExpr("1 div (id - id) AS id"), path)
    assert sinks.versions(spark, path) == [0, 1, 2, 3] and first.count() == 3
    assert sinks._only_once(spark, f"{path}/_versions/3", "other") is False and sinks.read_version(spark, path, 3).count() > 3
    with pytest.raises(ValueError, match="no version"):
        sinks.read_version(spark, path, 9)


def test_a_file_is_put_once(spark, tmp_path):
    """Both ways to put a version's manifest: the first one stays, whole, and nothing else is left."""
    import os

    for name, put in (("linked", lambda c: sinks._linked(f"{tmp_path}/linked/0", c)), ("renamed", lambda c: sinks._renamed(spark, f"file://{tmp_path}/renamed/0", c))):
        assert put("first") and not put("second") and (tmp_path / name / "0").read_text() == "first"
        assert [f for f in os.listdir(tmp_path / name) if not f.endswith(".crc")] == ["0"]


def test_paged_source(spark, tmp_path):
    """One task for each range, filters narrow the range, and a stream goes on where it stopped."""
    from corpusloom.sources import paged

    path = f"file://{tmp_path}/store"
    rows = spark.range(200).selectExpr("id", "cast(sqrt(id) as int) AS shelf", "concat('text ', id) AS text")
    paged.stored_pages(rows, "shelf", path)
    service = paged.FolderService(path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    paged.register_paged(spark, "shelves", service, "id bigint, shelf int, text string", "shelf", most=40, page_size=7)
    found = spark.read.format("shelves").load()
    spans = paged.number_spans(service.count, 0, 14, 40)
    assert found.rdd.getNumPartitions() == len(spans) > 4 and all(s.count <= 40 for s in spans)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
    some = spark.read.format("shelves").load().where("shelf >= 12 AND shelf < 14 AND text <> 'text 150'")
    assert some.count() == 13 * 13 - 12 * 12 + 14 * 14 - 13 * 13 - 1 and some.rdd.getNumPartitions() <= 2
    assert spark.read.format("shelves").load().where("shelf = 99").count() == 0
    with pytest.raises(ValueError, match="results for"):
        paged.number_spans(service.count, 0, 14, 5)

    def run():
        stream = spark.readStream.format("shelves").load()
        return incremental.run_available(stream, "shelves", checkpoint=str(tmp_path / "check"))

    assert run().count() == 200 and run().count() == 0


def test_many_terms_in_one_pass(spark):
    """The automaton finds what a search for every term finds, in a time that hardly grows with the terms."""
    import random
    import time

    from corpusloom.functions import automaton, lexicon

    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abc dé_1.") for _ in range(60)), "x") for i in range(80)] + [(-1, None, "x"), (-2, "", "x"), (-3, "C++ and R", "x")]
    lists = {"some": ["ab", "ab", "b c", "é", "Dé"], "text": ["c++", "r", "a_1", "1"], "none": []}
    df = spark.createDataFrame(rows, "id bigint, text string, some string")
    found = automaton.lexicon_hits(df, "text", automaton.Automaton(lists, whole=["text"]))
    assert found.columns == ["id", "text", "some", "none", "some_", "text_"]
    want = df.select("id", lexicon.any_substring(F.col("text"), lists["some"]).alias("s"), lexicon.any_word(F.col("text"), ["r", "a_1", "1"]).alias("w"))
    assert {(r.id, bool(r["some_"]), bool(set(r["text_"]) - {"c++"})) for r in found.collect()} == {tuple(r) for r in want.collect()}
    assert {r.id: r["some_"] for r in found.collect()} == {i: sorted({t.lower() for t in lists["some"] if t.lower() in (text or "").lower()}) for i, text, _ in rows}
    text = "".join(rng.choice("abcdefgh ") for _ in range(200_000))
    took = []
    for n in (500, 50_000):
        machine = automaton.Automaton({"l": {"".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(n)}})
        began = time.perf_counter()
        machine.found(text)
        took.append(time.perf_counter() - began)
    assert took[1] < 6 * took[0] + 0.05
