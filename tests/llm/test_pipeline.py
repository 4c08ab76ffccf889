"""The pipeline's stages on the smallest tables, each held against its own input."""

from collections import Counter

import corpus_pipeline
import pytest

from stratavox.llm import jaccard, mixing, personal, quality
from stratavox.llm.common import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents, then what each stage made of them."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay_but_for_the_last(steps):
    assert all(x.columns == steps[0].columns for x in steps[1:-1])


def test_only_bad_documents_go(spark, steps):
    scored = quality.score_quality(steps[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert ids(steps[1]) == Counter(r.doc_id for r in scored if r.score >= 0.5)
    assert 0 < steps[1].count() < steps[0].count()


def test_one_of_each_group_stays(steps):
    linked = jaccard.link_documents(steps[1]).collect()
    assert ids(steps[2]) == Counter({r.component_id for r in linked})


def test_no_base_span_is_left(steps):
    assert ids(steps[3]) == ids(steps[2])
    assert personal.find_personal(steps[3]).filter("size(base) > 0").count() == 0


def test_copies_are_those_drawn(steps):
    drawn = {r.doc_id: r.copies for r in mixing.draw(steps[3]).select("_row.doc_id", "copies").collect()}
    assert ids(steps[4]) == Counter({i: n for i, n in drawn.items() if n})


def test_every_copy_is_packed(steps):
    rows = steps[5].collect()
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.length
    tokens = {r.doc_id: r.doc_tokens for r in rows}
    assert total == Counter({i: tokens[i] * n for i, n in ids(steps[4]).items()})
    spots = sorted((r.sequence_id * 4096 + r.offset, r.length) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(spots, spots[1:], strict=False))
