"""The corpus pipeline stage by stage, each against brute force on its own input."""

import pytest

import corpus_pipeline
from tickloom.llm import line_dedup
from tickloom.llm._common import Store, table

from test_operators import similar_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage, written and read again."""
    store, docs, out = Store(spark), table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        kept = store.keep(stage(spark, docs, SF))
        out[name] = (docs, kept)
        docs = kept
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_order_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    own = table(spark, SF, "documents").columns
    for name, (_, kept) in stages.items():
        assert kept.columns[: len(own)] == own, name
        if name != "mixing":
            assert kept.columns == own


def test_quality_drops_the_bad_and_keeps_the_good(spark, stages):
    docs, kept = stages["quality"]
    marks = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    left = set(ids(kept))
    assert left <= set(ids(docs))
    good = [i in left for i, q in marks.items() if q == 1]
    assert sum(good) >= 0.97 * len(good)


def test_lines_are_unique_after_their_stage(stages):
    _, kept = stages["line_dedup"]
    lines = [s for r in kept.collect() for _, s in line_dedup.lines_of(r.text)]
    assert len(lines) == len(set(lines))
    assert all(r.n_chars == len(r.text) for r in kept.collect())


def test_one_document_of_each_group(stages):
    docs, kept = stages["near_duplicates"]
    group = similar_groups({r.doc_id: r.text for r in docs.collect()})
    assert ids(kept) == sorted(set(group.values()))


def test_clean_documents_stay(spark, stages):
    docs, kept = stages["decontamination"]
    from tickloom.llm import decontaminate

    bad = {r.doc_id for r in decontaminate.contamination(docs, table(spark, SF, "benchmark")).collect() if r.contaminated}
    assert ids(kept) == sorted(set(ids(docs)) - bad)


def test_mix_takes_from_what_is_left(stages):
    docs, kept = stages["mixing"]
    rows = kept.collect()
    assert set(ids(kept)) <= set(ids(docs))
    assert all(1 <= r.mix_copies <= 3 and r.mix_taken == r.mix_copies * len(r.text.split()) for r in rows)


def test_run_is_the_stages(spark, stages):
    got = sorted((r.doc_id, r.text, r.mix_copies) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.text, r.mix_copies) for r in stages["mixing"][1].collect())


def test_without_the_subpackage_the_entry_still_works():
    import subprocess
    import sys

    code = """
import sys
class Gone:
    def find_spec(self, name, *_):
        if name == "corpus_pipeline" or name.startswith("tickloom.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "market_aggregate_1h" in e.queries() and not any(n.startswith("op") and n[2].isdigit() for n in e.queries())
assert e.oracle_sql()
"""
    root = str(__import__("pathlib").Path(corpus_pipeline.__file__).parent)
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, timeout=100).returncode == 0
