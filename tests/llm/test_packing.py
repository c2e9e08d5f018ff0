import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tributary.llm import packing

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()


def check(rows, docs, tokenizer, limit=4096, segments=256):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) >= 0 and len(r["ids"]) == 4 * r["length"] > 0
        pieces[r["id"]].append((r["start"], bytes(r["ids"]), r["tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit and len(parts) <= segments
        assert at == limit or at & (at - 1) == 0
        short += at < limit
    want = defaultdict(list)
    for d, t, *_ in docs:
        want[d].append(ids_of(tokenizer, t))
    for d, texts in want.items():
        assert sum(len(p[1]) for p in pieces[d]) == sum(map(len, texts))
        if len(texts) == 1:
            assert b"".join(p[1] for p in sorted(pieces[d])) == texts[0]
            assert {p[2] for p in pieces[d]} == {len(texts[0]) // 4}
    assert set(pieces) == set(want)
    return short


def test_pieces_hold_each_id_once(nasty, nasty_rows, clashing, empty, tokenizer):
    check(packing.pack(nasty, NAME).collect(), nasty_rows, tokenizer)
    check(packing.pack(clashing, NAME).collect(), nasty_rows, tokenizer)
    check(packing.pack(nasty, NAME, window=4, max_tokens=64, cache=10).collect(), nasty_rows, tokenizer, 64)
    assert packing.pack(empty, NAME).collect() == []


def test_words_are_the_tokenizers(tokenizer):
    words = packing.WordTokens(public_tokenizers.path(NAME))
    r = random.Random(8)
    alphabet = list("abzAZ '.,!?|#$%&*-_0159\n\t\r\x0b\x1c\x85\xa0éÉßçñ") + ["'s", "'LL", "<|endoftext|>", "<|", "é", "İ", "Σ", "αΣ", "日本", "\U0001f600", " ", "​", "ﬁ", "²", "Ⅷ", "́"]
    for _ in range(4000):
        text = "".join(r.choices(alphabet, k=r.randint(0, 14)))
        assert words(text) == ids_of(tokenizer, text)[:-4], repr(text)


def test_three_limits_and_a_dot_product():
    r = random.Random(1)
    examples = []
    for k in range(500):
        n = r.choice([1, 2, 5, 30, 90])
        examples.append((k, n, r.randint(1, n)))
    total = {k: n for k, n, _ in examples}
    for cut in (True, False):
        packer = packing.Packer(100, 8, 60, cut=cut)
        seen = defaultdict(int)
        if not cut:
            examples = [(k, n, min(b, 60)) for k, n, b in examples]
        for sequence in packer.pack(examples):
            assert sum(n for _, _, n in sequence) <= 100 and len(sequence) <= 8
            loss = 0
            for k, start, n in sequence:
                seen[k] += n
                bearing = next(b for i, _, b in examples if i == k)
                loss += max(0, start + n - max(start, total[k] - bearing))
                assert cut or (start, n) == (0, total[k])
            assert loss <= 60
        assert seen == total


def test_an_example_over_the_limit_needs_cutting():
    with pytest.raises(ValueError):
        list(packing.Packer(10, cut=False).pack([(0, 11, 11)]))


def test_prompts_bear_no_loss(spark):
    rows = spark.createDataFrame([(1, "a b c d", "a b"), (2, "a b c d", None)], "doc_id long, text string, prompt string")
    found = packing.pack(rows, NAME, prompt_col="prompt", max_tokens=16, max_loss=5).collect()
    assert sum(r["length"] for r in found) == 10


def test_little_padding(spark, tokenizer):
    from .conftest import words

    docs = [(k, words(k, 20 + 37 * k)) for k in range(60)]
    assert check(packing.pack(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), NAME).collect(), docs, tokenizer) <= 12


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_any_tokenizer_gives_its_own_ids(name):
    """Words are kept for a tokenizer of the known form alone."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokens = packing.WordTokens(public_tokenizers.path(name))
    assert tokens.by_word == (name == NAME)
    for text in ("Hello World", "  two  spaces ", "École's 12 x", "a\n\nb", ""):
        assert tokens(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_one_short_end_a_partition(spark, tokenizer):
    """Short sequences are carried over windows: a partition ends in one sequence's powers of two."""
    from .conftest import words

    docs = [(k, words(k, 5 + 13 * (k % 40))) for k in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    for window in (1, 7, 50):
        rows = packing.pack(df, NAME, window=window, max_tokens=512).collect()
        assert check(rows, docs, tokenizer, 512) <= 9


def test_conversations_under_a_loss_limit(spark, tokenizer):
    """Instruction data: the answers bear loss, and their limit binds before the tokens do."""
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy("conv_id", "turn").collect()
    by = defaultdict(list)
    for t in turns:
        by[t["conv_id"]].append((t["role"], t["text"] or ""))
    rows = []
    for conv, said in sorted(by.items()):
        prompt = " ".join(x for role, x in said if role != "assistant")
        rows.append((conv, prompt + " " + " ".join(x for role, x in said if role == "assistant"), prompt))
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt string").coalesce(1)
    found = packing.pack(df, NAME, prompt_col="prompt", max_tokens=1024, max_segments=12, max_loss=256).collect()
    prompts = {d: len(ids_of(tokenizer, p)) // 4 - 1 for d, _, p in rows}
    loss, segments, sizes = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        loss[r["sequence_id"]] += max(0, r["start"] + r["length"] - max(r["start"], min(prompts[r["id"]], r["tokens"] - 1)))
        segments[r["sequence_id"]] += 1
        sizes[r["sequence_id"]] += r["length"]
    assert max(loss.values()) == 256 and max(segments.values()) <= 12 and max(sizes.values()) <= 1024
    assert sum(x == 256 for x in loss.values()) > len(loss) // 4
    assert sum(sizes.values()) == sum(len(ids_of(tokenizer, t)) // 4 for _, t, _ in rows)
