import sys
from pathlib import Path

import pytest
import sentencepiece
from brute import CLASHES, ODD_TEXTS, components, documents, sha, simhash
from test_decontaminate import brute as leaks
from test_lines import brute as deduped

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from clickloom.llm import quality  # noqa: E402
from clickloom.llm.queries import tokenizer  # noqa: E402


def brute(spark, docs, items):
    """The stages in plain code, but for the covariance estimates."""
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    texts = {i: t for i, (t, _, _) in deduped({i: texts[i] for i in kept}).items()}
    groups = components({i: simhash(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if groups[i] == i}
    found = leaks(texts, items)
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    out = set()
    for i, t in texts.items():
        if not found[i][-1]:
            ids = model.encode(t or "", add_eos=True)
            out.add((i, len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids))))
    return out


def test_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "encoding"]


def test_run_matches_brute_force(spark, sf_dir, table_rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(x) for x in table_rows("benchmark")[["item_id", "text"]].values]
    want = brute(spark, docs, items)
    got = list(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
    assert set(got) == want and len(got) == len(want)
    assert 0 < len(want) < docs.count()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_the_columns(spark, sf_dir, stage):
    docs = documents(spark, [*ODD_TEXTS, *ODD_TEXTS], schema=CLASHES)
    done = stage[1](spark, docs, sf_dir)
    assert done.schema.names == docs.schema.names
    assert done.count() <= docs.count()
    assert stage[1](spark, docs.where("false"), sf_dir).collect() == []


def test_clean_documents_pass_all_filters(spark, sf_dir):
    plain = documents(spark, [" ".join(f"word{i * 31 + k}" for k in range(60)) for i in range(40)])
    docs = plain
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in docs.collect()) == list(range(1, 41))
