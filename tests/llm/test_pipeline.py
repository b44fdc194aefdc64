import contextlib
import io
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
from docs import awkward, frame, prose, shingles
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickbars.llm import exact, mix, near, quality, rows
from tickbars.llm.queries import QUERIES, vocabulary
from tickbars.session import SCRATCH, shared_dir, stored

ROOT = Path(__file__).parents[2]


def corpus():
    english = " the and of it is to"
    clean = [(i, prose(i, 130) + english, "en", f"s{i % 3}", 1) for i in range(40)]
    copies = [(100 + i, clean[i][1].replace(" ", "  "), "en", "s0", 1) for i in range(10)]
    close = [(200 + i, clean[i][1] + " tail", "en", "s1", 1) for i in range(5, 15)]
    junk = [(300 + i, " ".join(f"{w}###" for w in prose(i, 130).split()), "en", "s2", 1) for i in range(6)]
    short = [(400 + i, "too short", "en", "s2", 1) for i in range(4)]
    return clean, copies, close, junk, short


def test_stages(spark):
    clean, copies, close, junk, short = corpus()
    docs = frame(spark, [*clean, *copies, *close, *junk, *short])
    rows = {r[0]: r[1] for part in corpus() for r in part}
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stored(stage(spark, docs, ""), name)
        assert out.columns == docs.columns
        have = Counter(r.doc_id for r in out.collect())
        if name == "quality_rules":
            assert have == Counter(r[0] for r in [*clean, *copies, *close])
        if name == "exact_dedup":
            texts = {"".join(rows[i].split()) for i in have}
            assert len(texts) == len(have) == 50
        docs = out
    # one of each group is left, and no two that are alike
    left = sorted(have)
    assert len(left) == 40 and all(
        100 * len(shingles(rows[a]) & shingles(rows[b])) < 75 * len(shingles(rows[a]) | shingles(rows[b])) for a in left for b in left if a < b
    )
    mixed = stored(corpus_pipeline.STAGES[3][1](spark, docs, ""))
    assert mixed.columns == docs.columns and set(r.doc_id for r in mixed.collect()) <= set(left)
    last = corpus_pipeline.STAGES[4][1](spark, mixed, "").collect()
    tokenizer = Tokenizer.from_file(vocabulary())
    assert len(last) == mixed.count() and all(tokenizer.decode(r.ids) == rows[r.doc_id] for r in last)


def test_run_equals_the_stages_by_hand(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = near.keep(stored(exact.keep(stored(quality.keep(docs)))))
    got = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in got.select("doc_id").collect()} <= {r.doc_id for r in want.select("doc_id").collect()}


def test_an_empty_table_passes_all_stages(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_runs(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_the_rest_works_without_this_part():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('tickbars.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 50 and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("keep", [exact.keep, near.keep, mix.keep], ids=["exact", "near", "mix"])
def test_whole_rows_are_exchanged_once(spark, keep):
    docs = frame(spark, awkward() * 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep(docs)
        # an aggregate's buffer of whole rows is named first
        assert len(re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[[^\]]*(?<=[\[ ])(?:_row|first)#", plan_of(kept))) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_are_kept_by_id_and_text(spark):
    docs = spark.createDataFrame([(i, t) for i in (None, "", "a", "b") for t in (None, "", "x")] * 2, "id string, text string")
    named = [(None, None), (None, "x"), ("", ""), ("a", "x"), ("c", "x")]
    kept = spark.createDataFrame(named, "id string, text string").select("id", rows.text_key(F.col("text")).alias("text_key"))
    got = rows.rows_kept(docs, kept, "id", "text").collect()
    assert Counter(map(tuple, got)) == Counter(named[:4])


def test_a_run_leaves_the_last_stage_only(spark, sf_dir):
    folder = Path(shared_dir(spark), SCRATCH)
    tables = lambda: {p.name for p in folder.iterdir()} if folder.exists() else set()
    before = tables()
    out = corpus_pipeline.run(spark, sf_dir)
    assert [name.split("-")[0] for name in tables() - before] == ["mix_sources"]
    assert out.count() > 0
