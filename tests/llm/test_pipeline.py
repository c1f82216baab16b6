"""The corpus pipeline, stage by stage, and the registration of its queries."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import brute
import corpus_pipeline
from rankloom.session import staged

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]
    columns = docs.columns

    good = staged(stages["quality"](spark, docs, SF), "t")
    assert good.columns == columns and good.exceptAll(docs).isEmpty()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = labels.join(good.select("doc_id"), "doc_id", "left_semi")
    assert kept.filter("quality = 0").count() <= 1 and kept.filter("quality = 1").count() >= 0.97 * labels.filter("quality = 1").count()

    lines = staged(stages["line_dedup"](spark, good, SF), "t")
    want = brute.line_dedup([(r.doc_id, r.text) for r in good.collect()])
    assert lines.columns == columns
    assert {r.doc_id: (r.text, r.n_chars) for r in lines.collect()} == {
        d: (t, len(t)) for d, (t, n, gone) in want.items() if gone == 0 or gone < n
    }

    single = staged(stages["near_duplicates"](spark, lines, SF), "t")
    groups = brute.linked([(r.doc_id, r.text) for r in lines.collect()])
    assert single.columns == columns
    assert {r.doc_id for r in single.collect()} == {d for d, (_, least) in groups.items() if d == least}

    clean = staged(stages["decontamination"](spark, single, SF), "t")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    flagged = {x[0] for x in brute.overlaps([(r.doc_id, r.text) for r in single.collect()], items)}
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - flagged

    packed = stages["packing"](spark, clean, SF)
    assert packed.select("doc_id").distinct().count() == clean.count()


def test_line_stage_keeps_what_does_not_repeat(spark):
    texts = ["one two three four five six", "one two three four five six\nonly here\nunique poem line", "One two three four five six", "only here", None]
    docs = spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SF).collect()}
    assert got == {0: (texts[0], 27), 1: ("only here\nunique poem line", 26), 4: (None, None)}


def test_one_row_of_a_repeated_id_stays(spark):
    """Rows of one id with different texts are one document: the row that comes first by its text stays."""
    rows = [(7, "b b b b b b", "x"), (7, "a a a a a a", "y"), (9, "c d e f g h", None), (9, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {(r.doc_id, r.text, r.lang) for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).collect()}
    assert got == {(7, "a a a a a a", "y"), (9, "c d e f g h", None)}


def test_stages_on_odd_and_empty_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, bucket int"
    odd = [(1, None, None, "s", None, "x", 1), (None, "a b c d e f", "en", None, 11, "x", 1), (2, "", "en", "s", 0, "x", 1),
           (3, "some words that are here once", "en", "s", 29, "x", 1), (3, "some words that are here once", "en", "s", 29, "x", 1)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = staged(stage(spark, docs, SF), "t")
            assert docs.columns == [c.split()[0] for c in schema.split(", ")], name
        assert docs.count() == (4 if rows else 0)


def test_entry_without_the_subpackage(tmp_path):
    """The other queries stay when the two folders and the pipeline file are gone."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('rankloom.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 100 and not any(q.startswith('op1') or q == 'pipeline' for q in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=120)


def test_registered():
    import __spark_entry__ as entry

    assert {q.split("_")[0] for q in entry.queries() if q.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in entry.queries()
