"""Aligned tokens, against whole texts encoded at once."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from brute import ODD
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tablesync.llm import tokenizer_align as align

PATHS = [public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD_TEXTS = [
    " a", "a ", "  a  b ", "a\n b", "a \nb", "a  b", "a  b", "　x y", "<|endoftext|> x<|endoftext|>",
    "<s> </s> <unk> <0x41>", "▁x ▁ y", "don't we'll", "日本語 のテキスト 日本", "🙂🙂 🙂", "a\tb\r\nc  d", "é́ ſ ﬁ",
    "x" * 300, "ab " * 200, "日本語" * 90, "a\x00b \x00 c", "a\x1c b c\x1d d", " ", "\n", "no-break  figure",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PATHS[1])


def plain(rows, tokenizers):
    tok_a, tok_b = tokenizers
    shown = align._byte_of()
    known, found = Counter(), []
    for doc_id, text in rows:
        raw = b" " + (text or "").encode()
        a = tok_a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tok_b.encode(text) if text else []
        bytes_a = [bytes(shown[c] for c in tok_a.id_to_token(i)) for i in a]
        pieces = [(tok_b.id_to_piece(i), tok_b.is_byte(i)) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if raw_byte else p.replace("▁", " ").encode() for p, raw_byte in pieces]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            found.append((doc_id, 0, 0, [], []))
            continue
        ends_a = [sum(map(len, bytes_a[: i + 1])) for i in range(len(a))]
        ends_b = [sum(map(len, bytes_b[: i + 1])) for i in range(len(b))]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        known.update(links)
        found.append((doc_id, len(a), len(b), groups, links))
    most = Counter()
    for (_, y), n in known.items():
        most[y] = max(most[y], n)
    return sorted(
        (
            (
                d, n_a, n_b, len(groups), len(links), sum(known[p] == most[p[1]] for p in links),
                sum(known[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for d, n_a, n_b, groups, links in found
        ),
        key=str,
    )


def found(frame, chunk=None, **options):
    facts = align.alignments(frame, *PATHS, chunk=chunk)
    return sorted(map(tuple, align.scored(facts, **options).collect()), key=str)


def rows_of(seed=2):
    dice = random.Random(seed)
    rows = ODD + list(enumerate(ODD_TEXTS, 100))
    for i in range(40):
        parts = [dice.choice(["the", "Thtion", "é", "x-y", "\n", " ", "", "日本", "don't", "1234", "."]) for _ in range(60)]
        rows.append((dice.choice([i, None, 1]), dice.choice([" ", " ", ""]).join(parts)))
    return rows + rows[-10:]


@pytest.mark.parametrize("chunk, broadcast_bytes", [(None, 1 << 20), (7, 0), (40, 0)])
def test_alignment_of_odd_texts(texts, tokenizers, chunk, broadcast_bytes):
    rows = rows_of()
    assert found(texts(rows), chunk, broadcast_bytes=broadcast_bytes) == plain(rows, tokenizers)


def test_documents(spark, sf_dir, tokenizers):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == plain(rows, tokenizers)


def test_empty_table_other_ids_and_columns(spark, texts, tokenizers):
    assert found(texts(ODD).limit(0)) == []
    frame = texts(rows_of()[:60]).selectExpr("cast(doc_id as string) as doc_id", "text", "1 as row", "2 as pairs", "3 as piece")
    want = plain([(None if d is None else str(d), t) for d, t in rows_of()[:60]], tokenizers)
    assert found(frame, 30) == want


def test_segments_are_forgotten(texts, tokenizers, monkeypatch):
    # the limit holds in the tests' own process only: workers are asked for it by a small class
    known = align.Tokenizers(*PATHS)
    monkeypatch.setattr(align, "KNOWN", 3)
    for text in ("a b c", "d e", "a b c d e f"):
        known.learn(set(text.split()))
        assert set(text.split()) <= set(known.number) and len(known.number) <= 6


_IDS = st.lists(st.integers(0, 3), max_size=12)


@settings(max_examples=200, deadline=None)
@given(_IDS, st.data())
def test_product_is_associative_and_equals_the_whole(ids, data):
    """Tokens 0 to 3 of A have 1 to 4 bytes; B cuts the same bytes elsewhere."""
    size = [1, 2, 3, 4]
    pairing = align.Pairing(size, size)
    total, other = sum(size[i] for i in ids), []
    while total:
        other.append(data.draw(st.integers(0, min(3, total - 1))))
        total -= size[other[-1]]
    total = sum(size[i] for i in ids)
    cuts = sorted(data.draw(st.lists(st.integers(0, total), max_size=4)))
    bounds = list(zip([0, *cuts], [*cuts, total]))
    parts = [pairing.fragment(ids, other, low, high) for low, high in bounds]
    left = parts[0]
    for part in parts[1:]:
        left = left * part
    right = parts[-1]
    for part in reversed(parts[:-1]):
        right = part * right
    whole = pairing.fragment(ids, other)
    assert left == right == whole
    assert align.Fragment() * whole == whole == whole * align.Fragment()
