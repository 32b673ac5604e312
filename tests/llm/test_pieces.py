import random

import public_tokenizers
import sentencepiece
from brute import CLASHES, ODD_TEXTS, documents, sha
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import pieces as op
from clickloom.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TABLE = op._table(PATH)


def library(text):
    ids = LIBRARY.encode(text or "", add_eos=True)
    return ids, LIBRARY.decode(ids)


def own(text):
    ids = TABLE.encode(text)
    return ids, TABLE.decode(ids)


def test_query_matches_the_library(spark, sf_dir, table_rows):
    want = set()
    for doc_id, text in table_rows("documents")[["doc_id", "text"]].values:
        ids, decoded = library(text)
        want.add((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert set(map(tuple, QUERIES["op3_sentencepiece"](spark, sf_dir).collect())) == want


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("aeinrst he▁\n.,1éß日", max_size=80)))
def test_any_text_matches_the_library(text):
    assert own(text) == library(text)


def test_all_pieces_side_by_side():
    words = [LIBRARY.id_to_piece(i).replace("▁", " ") for i in range(259, 32000, 7)]
    for i in range(0, len(words) - 40, 40):
        text = "".join(words[i : i + 40])
        assert own(text) == library(text)


def test_odd_rows(spark):
    docs = documents(spark, ODD_TEXTS, schema=CLASHES)
    got = docs.select("doc_id", op.encode(F.col("text"), PATH).alias("e")).select("doc_id", "e.*").collect()
    assert {r.doc_id: (r.ids, r.decoded) for r in got} == {i + 1: library(t) for i, t in enumerate(ODD_TEXTS)}
    assert docs.where("false").select(op.encode(F.col("text"), PATH)).count() == 0


def test_memory_is_bounded_and_keeps_what_is_used():
    small = op.PrefixTable(PATH)
    small.runs.half, small.pairs.limit = 2000, 3
    text = "several different words, twice: several different words " * 3 + " ".join(map(str, range(200)))
    assert small.encode(text) == library(text)[0]
    assert small.runs.used <= 2000 and len(small.pairs) <= 3
    assert sum(small.runs.size(k, v) for k, v in small.runs.young.items()) == small.runs.used


def test_the_pair_test_is_that_of_merging():
    rng = random.Random(1)
    stands = [i for text, i in TABLE.piece.items() if text in TABLE.automaton]
    short = [i for i in stands if len(TABLE.text[i]) < 3]
    for k in range(20_000):
        a, b = rng.choice(short if k % 2 else stands), rng.choice(short if k % 3 else stands)
        x, y = TABLE.text[a], TABLE.text[b]
        assert TABLE.follows(a, b) == (TABLE.merged(x + y)[0] == [x, y])


@given(st.lists(st.integers(0, 31_999), max_size=30))
def test_any_ids_decode_as_by_the_library(ids):
    """Decoding has the ids only; the library drops a leading mark, where there is one."""
    pieces = [i for i in ids if TABLE.text[i] or i in TABLE.byte]
    first = TABLE.piece["▁a"]
    assert TABLE.decode([first, *pieces]) == LIBRARY.decode([first, *pieces])


def test_long_texts_without_a_space(spark):
    for text in ("x" * 3000, "日本" * 400, "ab" * 2000 + "\n" + "😀" * 300):
        assert own(text) == library(text)


def test_a_single_character_needs_no_pair_test():
    fresh = op.PrefixTable(PATH)
    text = "Every prefix has a last piece: größer, niño, 1.234 x7z " * 3
    assert fresh.encode(text) == library(text)[0]
    assert fresh.pairs and not [k for k in fresh.pairs if len(fresh.text[k & 0xFFFF]) == 1]


def test_the_pair_test_of_single_characters_is_that_of_merging():
    rng = random.Random(2)
    single = [i for text, i in TABLE.piece.items() if len(text) == 1]
    stands = single + [i for text, i in TABLE.piece.items() if text in TABLE.automaton]
    for k in range(20_000):
        a, b = rng.choice(single if k % 2 else stands), rng.choice(single if k % 3 else stands)
        x, y = TABLE.text[a], TABLE.text[b]
        assert TABLE.follows(a, b) == (TABLE.merged(x + y)[0] == [x, y])


def test_a_mark_made_of_byte_pieces_stays():
    coded = [TABLE.bytes[x] for x in op.MARK.encode()]
    ids = [TABLE.piece["▁a"], *coded, TABLE.piece["▁a"]]
    assert TABLE.decode(ids) == LIBRARY.decode(ids) == "a▁ a"
