"""SentencePiece ids against the library, and exact round trips."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from canton.llm import sentencepieces as own
from canton.llm.arrays import give_back


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


TEXTS = [
    "",
    None,
    " ",
    "a  b\n\tc é ﬁ Ⅳ  ",
    "        x" * 5 + " " * 40,
    "日本語 <s> </s> <0x0A> ▁x ab\x00c 😀😀",
    "x" * 3000 + "aaaa" * 500 + "\n\n\n",
    "▁▁a ▁",
]


def noise(seed, n):
    rng = random.Random(seed)
    pool = "abcdefghijklmnoprstuvw   éßñABC.,0123\n" + "ᚠ中文"
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 400))) for _ in range(n)]


def test_ids_equal_the_library(spark, sf_dir, library, monkeypatch):
    made = [(i, t, 1) for i, t in enumerate(TEXTS + noise(7, 60))] + [(0, "twice", 1), (None, "none", 1)]
    frames = [
        spark.createDataFrame(made, "doc_id long, text string, ids int").repartition(3),
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
    ]
    for docs in frames:
        want = sorted(((r.doc_id is None, r.doc_id or 0), library.encode(r.text or "")) for r in docs.collect())
        encoded = own.encode_documents(docs)
        got = encoded.collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.ids) for r in got) == want
        assert all(r.n_tokens == len(r.ids) for r in got)
        texts = sorted(((r.doc_id is None, r.doc_id or 0), (r.text or "").replace("▁", " ")) for r in docs.collect())
        back = own.decode_documents(encoded).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in back) == texts
    assert own.encode_documents(frames[0].limit(0)).count() == 0
    assert [r.round_trip for r in own.encode_documents(frames[0].where("doc_id in (5, 6)")).collect()].count(False) == 1


def test_bounded_caches(library, monkeypatch):
    monkeypatch.setattr(own, "CACHE_WORDS", 50)
    monkeypatch.setattr(own, "CACHE_PAIRS", 40)
    pieces = own.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    import numpy as np

    for text in noise(9, 40):
        (got,) = pieces.encode([text])
        assert np.frombuffer(got, np.int32).tolist() == library.encode(text)
        assert len(pieces.cache) <= max(50, len(set(pieces.words.findall(own.SPACE + text.replace(" ", own.SPACE)))))


def test_long_texts_without_spaces(library, monkeypatch):
    """100,000 characters in one word: letters, Chinese, one letter, odd signs; equal to the library in seconds."""
    import time

    import numpy as np

    rng = random.Random(4)
    pieces = own.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    prose = "".join(rng.choice(["the", "and", "tion", "er", "in", "wh", "é", "Q", "zz"]) for _ in range(100_000))[:100_000]
    chinese = "".join(chr(rng.randint(0x4E00, 0x6000)) for _ in range(100_000))
    begun = time.monotonic()
    for text in (prose, chinese, "a" * 100_000, "ᚠ😀" * 30_000, prose[:700] + "\n" + chinese[:900] + " " + prose[:201]):
        (ids,) = pieces.encode([text])
        assert np.frombuffer(ids, np.int32).tolist() == library.encode(text)
    assert time.monotonic() - begun < 60
    # Parts of a long word overlap by a piece.
    monkeypatch.setattr(own, "INDEX_CHARS", 97)
    monkeypatch.setattr(own, "CACHE_PAIRS", 500)
    for text in (prose[:3000], chinese[:1500], "ab" * 700, *noise(3, 5)):
        (ids,) = pieces.encode([text.replace(" ", "")])
        assert np.frombuffer(ids, np.int32).tolist() == library.encode(text.replace(" ", ""))


def test_a_task_gives_its_freed_memory_back():
    def used():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())))

    seen = []

    def batches():
        held = [np.ones(500) for _ in range(40_000)]  # 160 MB in small pieces, the last of which stays
        yield held[-1]
        seen.append(used())

    kept = list(give_back(batches()))
    assert len(kept) == 1 and used() < seen[0] - 100_000
