"""Each stage on its own input, against the operator's plain parts."""

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shopgrain.llm import stages
from shopgrain.llm.pii import find_spans, redacted
from shopgrain.llm.simhash import fingerprint

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "pii", "mixing", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_selection_keeps_documents_as_they_are(spark):
    """On the next larger tables: the labels of the smallest are too few to reject a row."""
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = stages.select(spark, docs, sf_dir)
    assert out.columns == docs.columns
    rows, kept = docs.collect(), out.collect()
    assert not Counter(kept) - Counter(rows) and 0.6 * len(rows) < len(kept) < len(rows)


def test_one_document_of_each_group_stays(spark, docs):
    extra = [(-1, None, "en", "s", 0), (-2, "", "en", "s", 0), (7, "w " * 9, "en", "s", 0), (7, "w " * 9, "en", "s", 0)]
    extra += [(None, "a text without an id that stays alone here", "en", "s", 0)]
    extra += [(None, "w " * 9, "en", "s", 0)]
    df = docs.where("doc_id != 7").unionByName(spark.createDataFrame(extra, SCHEMA))
    rows = df.collect()
    prints = [fingerprint(r.text, 4) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    groups = {}
    for r, g in zip(rows, root, strict=True):
        groups.setdefault(g, set()).add(r.doc_id)
    expected = Counter(min((i for i in ids if i is not None), default=None) for ids in groups.values())
    out = stages.deduplicate(spark, df, SF_DIR)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == expected


def test_ids_do_not_decide_about_other_groups(spark):
    """Unrelated texts of one id all stay; of near copies without an id, one does."""
    words = " ".join(f"w{i}" for i in range(300))
    near = [f"{words} tail{i}" for i in range(3)]
    prints = [fingerprint(t, 4) for t in near]
    assert all((a ^ b).bit_count() <= 4 for a in prints for b in prints)
    other = " ".join(f"unrelated{i}" for i in range(80))
    rows = [(5, other, "en", "a", 1), (5, "another text altogether, and not a copy", "en", "a", 1)]
    rows += [(None, t, "en", "a", 1) for t in near] + [(9, None, "en", None, None)]
    rows += [(5, other, "en", "b", 1), (9, "\t", None, "s", 2), (8, "  ", "x", "s", 2)]
    out = stages.deduplicate(spark, spark.createDataFrame(rows, SCHEMA), SF_DIR).collect()
    assert sorted((r.doc_id or 0, r.source or "") for r in out) == [(0, "a"), (5, "a"), (5, "a"), (8, "s")]
    assert {r.text for r in out if r.doc_id == 5} == {rows[0][1], rows[1][1]}
    assert {r.text for r in out if r.doc_id is None} < set(near)


def test_marks_replace_personal_data(spark, docs):
    out = {r.doc_id: r for r in stages.redact(spark, docs, SF_DIR).collect()}
    rows = docs.collect()
    assert len(out) == len(rows)
    for r in rows:
        assert out[r.doc_id].text == redacted(r.text, find_spans(r.text))
        assert out[r.doc_id].n_chars == len(out[r.doc_id].text)


def test_mix_takes_words_of_documents(spark, docs):
    df = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, "a  b\tc " * 99, "x", None, 0)], SCHEMA))
    rows, out = df.collect(), stages.mix(spark, df, SF_DIR).collect()
    words = Counter()
    for r in rows:
        words[r.doc_id] += len((r.text or "").encode().split())
    taken, texts = Counter(), {r.doc_id: r.text for r in rows}
    for r in out:
        taken[r.doc_id] += len(r.text.encode().split())
        assert all(part in texts[r.doc_id] for part in r.text.split("\n\n") if "\n" not in part)
    assert all(taken[d] <= 2 * words[d] for d in taken)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(words.values()), rel=0.03)
    assert all(r.n_chars == len(r.text) for r in out)


def test_ids_decode_to_texts(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in stages.encode(spark, docs, SF_DIR).collect():
        assert r.n_tokens == len(r.ids)
        assert library.decode(r.ids, skip_special_tokens=False) == texts[r.doc_id]


def test_whole_pipeline(spark, docs):
    out = corpus_pipeline.run(spark, SF_DIR)
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    got = out.collect()
    assert got and {r.doc_id for r in got} < ids
    assert max(Counter(r.doc_id for r in got).values()) <= 2


def test_empty_tables(spark, docs):
    """No documents, and documents of which nothing is left."""
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF_DIR)
        assert none.count() == 0
        none = none if "text" in none.columns else None
