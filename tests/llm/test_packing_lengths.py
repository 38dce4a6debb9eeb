from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer, models, pre_tokenizers

from medalake.llm import lengths, packing

ODD = [
    None, "", " ", "Hello, WORLD!!", "it's <|endoftext|> <|EndOfText|> x", "Á é z",
    "a" * 5000, "word " * 9000, "ΣΑΣ σς İ ﬁ", "tab\tnew\nline\x0bv\x0cf\rr\x1cq", "1234 ٣² don't, 'LL",
    "é, ñ. ×. “quoted”. end…", "!!! ... ,", "x.,y x.. z,,", "dup", "dup",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_round_trip(frame, tokenizer):
    rows = [(i if i else None, t) for i, t in enumerate(ODD)]
    cut = packing.pieces(frame(rows, "doc_id bigint, text string"), keep_ids=True).collect()
    parts = defaultdict(list)
    for p in cut:
        assert p.length == len(p.ids) // 4 <= packing.SEQUENCE and p.ids_crc32 == crc32(p.ids)
        parts[p.doc_id].append(p)
    for id_, text in rows:
        mine = sorted(parts[id_], key=lambda p: p.start)
        ids = np.frombuffer(b"".join(p.ids for p in mine), "<u4").tolist()
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [1], text
        assert [p.start for p in mine] == list(range(0, len(ids), packing.SEQUENCE))
        assert {p.doc_tokens for p in mine} == {len(ids)}


def test_words_that_were_let_go_come_back(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "CACHED_WORDS", 8)
    known = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    for k in range(30):
        text = f"same words, {k} and {k % 3}. é, same"
        ws = packing._words(text.encode())
        known.learn(set(ws))
        ids = np.frombuffer(b"".join(known[w] for w in ws), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_new_words_share_texts(monkeypatch, tokenizer):
    """Words of one piece are encoded many to a text, and have the ids that they have in place."""
    rng = np.random.default_rng(11)
    letters = [*"abcdefghijklmnopqrstuvwxyzäßéñÉÀ"]
    words = ["".join(rng.choice(letters, rng.integers(1, 14))) for _ in range(3000)]
    ends = ["", ".", ",", "!?", "'", "$$$", "</", ">"]
    texts = [
        " ".join(w + ends[rng.integers(len(ends))] for w in words[k : k + 60]) + odd
        for k, odd in zip(range(0, 3000, 60), [" it's", " x1.", " a=\u0338", " \u0301b.", "\xa0É."] * 10)
    ]
    known = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    encoded = []

    class Counting:
        def encode_batch_fast(self, batch, **options):
            encoded.extend(batch)
            return tokenizer.encode_batch_fast(batch, **options)

    known.tokenizer = Counting()
    spelled = [packing._words(t.encode()) for t in texts]
    known.learn(set().union(*spelled))
    for text, ws in zip(texts, spelled):
        ids = np.frombuffer(b"".join(known[w] for w in ws), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text
    # Capital É and À of these words are left to the tokenizer.
    plain = [w for w in words if not {*"ÉÀ"} & {*w}]
    assert len(encoded) < len(words) - len(plain) + len(plain) / 20


@pytest.mark.parametrize("kind", ["added token", "one token a word"])
def test_words_of_other_vocabularies(kind, tmp_path):
    text = "hello, low hole! helo hello"
    if kind == "one token a word":
        model = models.WordLevel({"hello": 0, "low": 1, ",": 2, "?": 3}, unk_token="?")
    else:
        vocabulary = [c + end for c in "helow,!" for end in ("", "</w>")]
        ids = {c: i for i, c in enumerate(vocabulary)}
        model = models.BPE(ids, [], end_of_word_suffix="</w>")
    other = Tokenizer(model)
    other.pre_tokenizer = pre_tokenizers.Whitespace()
    if kind == "added token":
        other.add_tokens(["lo"])
    other.save(path := str(tmp_path / "other.json"))
    ws = packing._words(text.encode())
    known = packing.WordIds(path)
    known.learn(set(ws))
    got = np.frombuffer(b"".join(known[w] for w in ws), "<u4").tolist()
    assert got == other.encode(text, add_special_tokens=False).ids


def test_first_fit_is_first_fit():
    rng = np.random.default_rng(4)
    sizes = np.sort(rng.integers(1, 2049, 300))[::-1].copy()
    bins, offsets = packing.first_fit(sizes, 2048)
    room: list[int] = []
    for size, b, at in zip(sizes, bins, offsets):
        want = next((i for i, r in enumerate(room) if r >= size), len(room))
        if want == len(room):
            room.append(2048)
        assert (b, at) == (want, 2048 - room[want])
        room[want] -= size
    assert len(packing.first_fit(np.array([2048]), 2048)[0]) == 1


def test_sequences_are_gapless(frame):
    rng = np.random.default_rng(0)
    rows = [(int(i) if i % 9 else None, "tok " * int(n)) for i, n in enumerate(rng.integers(0, 3000, 120))]
    placed = packing.pack(
        packing.pieces(frame(rows, "doc_id bigint, text string"), keep_ids=True), group_pieces=50
    )
    got, by = placed.collect(), defaultdict(list)
    for p in got:
        by[p.sequence_id].append((p.offset, p.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    tokens = sum(p.length for p in got)
    assert tokens == sum(t.count("tok") + 1 for _, t in rows)
    assert len(by) * packing.SEQUENCE < 1.15 * tokens
    whole = packing.sequences(placed).collect()
    assert len(whole) == len(by) and sum(s.n_ids for s in whole) == tokens
    assert all(len(s.ids) == packing.SEQUENCE for s in whole)


def test_packing_an_empty_table(frame):
    assert packing.pack(packing.pieces(frame([], "doc_id bigint, text string"))).count() == 0


def test_lengths_against_brute_force(frame, monkeypatch):
    monkeypatch.setattr(lengths, "BLOCK", 4)
    encoding = lengths._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert isinstance(encoding, tiktoken.Encoding)
    sizes = [len(encoding.encode_ordinary(t or "")) for t in ODD]
    sums = lengths.with_suffix_sums(lengths.histogram(frame([(t,) for t in ODD], "text string")))
    got = {r.length: r for r in sums.collect()}
    assert {n: r.docs for n, r in got.items()} == Counter(sizes)
    for n, r in got.items():
        assert r.docs_from == sum(s >= n for s in sizes)
        assert r.tokens_from == sum(s for s in sizes if s >= n)
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
    limits = [0, 1, 7, 10_000]
    for r in lengths.truncated_totals(sums, limits).collect():
        assert r.kept_tokens == sum(min(s, r.limit_ids) for s in sizes)
        assert r.cut_docs == sum(s > r.limit_ids for s in sizes)
        assert r.kept_tokens + r.cut_tokens == sum(sizes)
    ordered = sorted(sizes)
    for r in lengths.quantiles(sums, [0.0, 0.25, 0.5, 1.0]).collect():
        assert r.length == ordered[max(0, -(-int(r.share * 100) * len(sizes) // 100) - 1)]


def test_lengths_of_an_empty_table(frame):
    sums = lengths.with_suffix_sums(lengths.histogram(frame([], "text string")))
    assert sums.count() == 0
    assert lengths.truncated_totals(sums, [5]).first().kept_tokens == 0
