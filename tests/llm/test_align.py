"""Cross-tokenizer alignment against a plain version over the libraries, and its odd inputs."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter

import pytest

from corvid.llm import align

from .test_texts import ODD, words_of


@pytest.fixture(scope="module")
def load():  # noqa: ANN201
    return align.named("byte_bpe_50k.json", "piece_bpe_32k.model")


def plain(rows: list) -> list:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) by loops over the libraries' own tokens."""
    import public_tokenizers as p
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=p.path("piece_bpe_32k.model"))
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbol = {chr(x): x for x in shown} | {chr(0x100 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def spelled_b(i: int) -> bytes:
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    done, counts = [], Counter()
    for doc, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw = [[bytes(symbol[c] for c in a.id_to_token(i)) for i in ids_a], [spelled_b(i) for i in ids_b]]
        if text and any(b"".join(x) != (" " + text).encode() for x in raw):
            ids_a, ids_b, raw = [], [], [[], []]
        ends = []
        for x in raw:
            at, own = 0, []
            for y in x:
                at += len(y)
                own.append(at)
            ends.append(own)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(x, y) for x, e in zip(ids_a, ends[0], strict=True) for y, f in zip(ids_b, ends[1], strict=True) if e == f] if len(ids_a) < 400 else None
        if links is None:  # the same, without the square
            at_b = dict(zip(ends[1], ids_b, strict=True))
            links = [(x, at_b[e]) for x, e in zip(ids_a, ends[0], strict=True) if e in at_b]
        parts: list = [([], []) for _ in cuts]
        for side in (0, 1):
            for i, e in zip((ids_a, ids_b)[side], ends[side], strict=True):
                parts[bisect_left(cuts, e)][side].append(str(i))
        groups = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in parts)
        counts.update(links)
        done.append((doc, len(ids_a), len(ids_b), len(cuts), links, groups))
    top: dict = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [
        (doc, na, nb, nc, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), "" if not na else hashlib.sha256(g.encode()).hexdigest())
        for doc, na, nb, nc, links, g in done
    ]


def test_equals_the_plain_version(spark, load, monkeypatch) -> None:  # noqa: ANN001
    texts = [*ODD, "<s> a</s> <unk>", "<0x41>", "▁a ▁", "a\x00b", "ﬁ ½ ①", "﻿x", "été  là", *(words_of(n, n) for n in (5, 200, 900))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[30]), (3, texts[30]), (None, "x y the the"), (77, " the the ")]
    monkeypatch.setattr(align, "CHUNK", 1500)  # chunks of several texts, and texts longer than a chunk
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, pairs int, n_a string").repartition(3)
    found = align.align(docs, load)
    got = [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_a_very_long_text_and_nothing(spark, load) -> None:  # noqa: ANN001
    long = words_of(60_000, 7)
    found = {r["doc_id"]: r for r in align.align(spark.createDataFrame([(1, long), (2, long[:300]), (3, None)], "doc_id bigint, text string"), load).collect()}
    assert found[1]["n_a"] > 100_000 and found[1]["n_links"] == found[1]["n_groups"] and found[3]["n_a"] == 0 and found[3]["groups_sha256"] == ""
    assert found[1]["count_sum"] >= found[1]["n_links"] >= found[1]["n_best"] > 0
    assert align.align(spark.createDataFrame([], "doc_id bigint, text string"), load).collect() == []


def test_pairs_are_bounded_by_the_vocabularies(load) -> None:  # noqa: ANN001
    assert 100_000 < load().proved_bound() < 2_000_000
