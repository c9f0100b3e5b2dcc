import json
import time

import pytest
from pyspark.sql import functions as F

from gleaner.operators import chunking
from gleaner.sources import corpus, tables
from gleaner.sources import results as rs
from gleaner.sources.scratch import scratch_root, stage
from tests.conftest import rows


def test_corpus_reads_whole_markdown_files_only(spark, tmp_path):
    (tmp_path / "A.md").write_text("# One\n\ntext\n")
    (tmp_path / "B.md").write_text("two\nlines")
    (tmp_path / "C.txt").write_text("skip me")
    docs = corpus.read_corpus(spark, str(tmp_path))
    assert rows(docs.select("file_name", "text"), "file_name") == [("A.md", "# One\n\ntext\n"), ("B.md", "two\nlines")]
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="empty or missing"):
        corpus.read_corpus(spark, str(tmp_path / "empty"))


PAGE = (
    "<html><head><title>T</title><style>p{}</style><script>var t='</p>';x()</script></head><body><nav><a href='/'>Home</a></nav>"
    "<h1>Head &amp; more</h1><p>First <b>bold</b>\n line.</p><ul><li>one</li><li>two</li></ul><h2>Sub</h2><p>caf&eacute;</p></body></html>"
)


def test_page_text():
    assert corpus.page_text(PAGE) == "# Head & more\n\nFirst bold line.\n\n- one\n- two\n\n## Sub\n\ncafé"
    assert corpus.page_text("<p>unclosed <b>text") == "unclosed text"
    assert corpus.page_text("") == ""


def test_pages_to_sections(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "plain"), (3, None)], "page_id bigint, html string")
    converted = corpus.convert_pages(pages)
    assert converted.filter("error IS NOT NULL").select("page_id").collect()[0][0] == 3
    sections = corpus.markdown_sections(converted.filter("error IS NULL"), "page_id")
    assert rows(sections.select("page_id", "heading", "text"), "page_id", "section_no") == [
        (1, "Head & more", "First bold line.\n\n- one\n- two"), (1, "Sub", "café"), (2, None, "plain")
    ]
    done = spark.createDataFrame([(1,)], "page_id bigint")
    assert [r["page_id"] for r in corpus.pending(pages, done, "page_id").orderBy("page_id").collect()] == [2, 3]


def test_case_files_keep_commas_quotes_and_lines(spark, tmp_path):
    data = [('What, "exactly", is PC18?', "contains: a.md"), ("two\nlines", "contains: b.md"), ("plain", "contains: c.md")]
    rs.write_cases(spark.createDataFrame(data, rs.CASE_SCHEMA), str(tmp_path / "cases"))
    assert sorted(rows(rs.read_cases(spark, str(tmp_path / "cases")))) == sorted(data)
    (tmp_path / "hand.csv").write_text('input,__expected\n"Under rule 1, what?",contains: A.md\nPlain?,contains: B.md\n')
    assert rows(rs.read_cases(spark, str(tmp_path / "hand.csv"))) == [("Under rule 1, what?", "contains: A.md"), ("Plain?", "contains: B.md")]


def test_union_of_case_tables(spark):
    a = spark.createDataFrame([("q", "contains: x")], "input string, __expected string")
    b = spark.createDataFrame([("r", "llm-rubric: y")], "input string, __expected1 string")
    assert rows(rs.union_cases(a, b), "input") == [("q", "contains: x", None), ("r", None, "llm-rubric: y")]


def test_evaluation_file(spark, tmp_path):
    document = {
        "results": {
            "prompts": [{"provider": "rag/naive", "metrics": {"testPassCount": 1, "testFailCount": 1, "totalLatencyMs": 300.0, "tokenUsage": {"numRequests": 2}}}],
            "results": [
                {"provider": {"id": "rag/naive"}, "latencyMs": 100, "gradingResult": {"pass": True}, "score": 1, "prompt": {"raw": "x" * 80}, "testIdx": 0},
                {"provider": {"id": "rag/bm25"}, "latencyMs": 200, "gradingResult": {"pass": False}, "score": 0, "prompt": {"raw": "y"}, "testIdx": 1},
            ],
        }
    }
    (tmp_path / "results.json").write_text(json.dumps(document, indent=2))
    evaluation = rs.read_eval(spark, str(tmp_path / "results.json"))
    assert rows(rs.flat_results(evaluation), "test_idx") == [("Naive", 100.0, True, 1.0, "x" * 60 + "...", 0), ("BM25", 200.0, False, 0.0, "y...", 1)]
    assert rows(rs.provider_counters(evaluation)) == [("Naive", 1, 1, 300.0, 2)]
    with pytest.raises(Exception):
        rs.read_eval(spark, str(tmp_path / "missing.json"))


def test_request_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(2):
        rs.append_request_log(spark.createDataFrame([(i, "p")], "n bigint, prompt string"), path)
    assert rows(spark.read.json(path, schema="n bigint"), "n") == [(0,), (1,)]


def test_itinerary(spark, tmp_path):
    flights = spark.createDataFrame([(1, "NZ$2164"), (2, None)], "trip bigint, flight_booking_data string")
    events = spark.createDataFrame([(1, '{"status": "success"}'), (2, "x")], "trip bigint, event_booking_data string")
    made = rs.itinerary(flights, events, "trip")
    parsed = [json.loads(r["itinerary"]) for r in made.orderBy("trip").collect()]
    assert parsed == [
        {"flight_booking_data": "NZ$2164", "event_booking_data": '{"status": "success"}'}, {"flight_booking_data": None, "event_booking_data": "x"}
    ]
    rs.write_itineraries(made, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_event_payload_without_sessions(spark):
    payload = json.dumps({"events": [{"name": "a", "sessions": {"sessions": [{"datetime_start": "2025-01-01", "datetime_end": "2025-01-02"}]}}, {"name": "b"}, {"name": "c", "sessions": {}}]})
    got = rs.parse_events(spark.createDataFrame([(payload,)], "value string")).select("name", F.size("sessions"))
    assert rows(got, "name") == [("a", 1), ("b", 0), ("c", 0)]


def test_stores(spark, tmp_path):
    documents = spark.createDataFrame([(1, "a.md", "one two"), (2, "b.md", "three")], "doc_id bigint, file_name string, text string")
    chunks = chunking.with_content_hash(chunking.chunk_windows(documents))
    path = str(tmp_path / "chunks")
    assert tables.ingest_delta(chunks, None).count() == 2
    tables.write_chunks(chunks.filter("doc_id = 1"), path)
    assert [r["doc_id"] for r in tables.ingest_delta(chunks, tables.read_chunks(spark, path)).collect()] == [2]
    tables.write_chunks(chunks.limit(0), str(tmp_path / "none"))
    with pytest.raises(ValueError, match="empty or missing"):
        tables.read_chunks(spark, str(tmp_path / "none"))
    vectors = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    tables.write_vectors(vectors, str(tmp_path / "vectors"), "naive")
    tables.write_vectors(vectors, str(tmp_path / "vectors"), "bm25")
    assert rows(tables.vector_counts(tables.read_vectors(spark, str(tmp_path / "vectors"))), "collection") == [("bm25", 1), ("naive", 1)]
    assert tables.read_vectors(spark, str(tmp_path / "vectors"), "bm25").columns == ["vec_id", "embedding"]


def test_scratch_is_the_configured_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert rows(stage(spark.range(3), "three"), "id") == [(0,), (1,), (2,)]


def test_a_staged_table_leaves_no_exchanges(spark):
    kept = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    many = [spark.range(1000).groupBy((F.col("id") % 7 + i).alias("k")).count() for i in range(3)]
    before = kept()
    staged = [stage(df, "exchanged") for df in many]
    for _ in range(50):  # they are removed in the background
        if kept() <= before:
            break
        time.sleep(0.1)
    assert kept() <= before
    assert [df.count() for df in staged] == [7, 7, 7]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_headings_in_code_fences_are_text(spark):
    text = "# A\nx\n```py\n# no heading\n``\n~~~\n````\n## B\ny\n~~~\n# also none\n```\n~~~\n### C\n# D\n ```\n# open to the end"
    got = corpus.markdown_sections(spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "#none\n  # none")], "doc_id bigint, text string"))
    assert rows(got.select("doc_id", "section_no", "level", "heading", F.array_join("path", "/"), "text"), "doc_id", "section_no") == [
        (1, 1, 1, "A", "A", "x\n```py\n# no heading\n``\n~~~\n````"), (1, 2, 2, "B", "A/B", "y\n~~~\n# also none\n```\n~~~"),
        (1, 3, 3, "C", "A/B/C", ""), (1, 4, 1, "D", "D", "```\n# open to the end"), (4, 0, 0, None, "", "#none\n  # none"),
    ]
