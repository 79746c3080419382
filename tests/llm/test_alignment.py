"""Op 11 against whole texts encoded at once, and its fragments against each other."""

import hashlib
import random
from collections import defaultdict

import public_tokenizers
import pytest

from lakehound.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row long, pair string, n_a string, block int"


def _texts():
    rnd = random.Random(5)
    some = ["plain words here", "", None, " ", "  two  blanks ", "tabs\tand\nlines \n x", "<|endoftext|> <s> <0x41> <unk>", "café naïve 漢字 \U0001f600 éè",
            "é ́x   　y  z", "x▁y", "it's 12.5 $%& don't", "\x00 \x7f a \x7f", "nul\x00", "a  b \x85c", "plain words here",
            "\r\n\r\n x", "word" * 50, "é" * 30 + " é " + "ß" * 9]
    many = ["".join(rnd.choice("ab \n\t.'é漢 1<x") for _ in range(rnd.randint(1, 60))) for _ in range(150)]
    long = " ".join(rnd.choice(["river", "stone", "été", "12,5", "  x", "\nnew", "tokenization"]) + str(rnd.randint(0, 99)) for _ in range(3000))
    return some + many + [long, long[:5000] + "q" * 700 + long[5000:9000], "z" * 900 + " ▁ " + long[:3000]]


def _brute(rows):
    own = alignment.Aligner(A, B)
    docs, counts = [], defaultdict(int)
    for doc_id, text in rows:
        want = (" " + text).encode() if text else b""
        a = own.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = own.b.encode(text) if text else []
        if b"".join(own.bytes_a[i] for i in a) != want or b"".join(own.bytes_b[i] for i in b) != want:
            a, b = [], []
        at_a, at_b = [], []
        for ids, sizes, at in ((a, own.len_a, at_a), (b, own.len_b, at_b)):
            p = 0
            for i in ids:
                at.append((i, p, p + int(sizes[i])))
                p += int(sizes[i])
        cuts = sorted({e for _, _, e in at_a} & {e for _, _, e in at_b})
        groups, low = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, s, e in at_a if low <= s < c) + "|" + ",".join(str(i) for i, s, e in at_b if low <= s < c))
            low = c
        links, j = [], 0
        for i, s, e in at_a:
            while j and at_b[j - 1][2] > s:
                j -= 1
            while j < len(at_b) and at_b[j][1] < e:
                if at_b[j][2] > s:
                    links.append((i, at_b[j][0]))
                j += 1
        for pair in set(links):
            counts[pair] += 1
        docs.append((doc_id, a, b, groups, links))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return sorted(((d, len(a), len(b), len(g), len(li), sum(counts[p] == top[p[0]] for p in li), sum(counts[p] for p in li),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, g, li in docs), key=str)


@pytest.mark.parametrize(("chunk", "fan"), [(1 << 16, 16), (96, 3)])
def test_rows_against_whole_texts(spark, chunk, fan):
    texts = _texts()
    rows = list(enumerate(texts)) + [(3, texts[0]), (3, texts[0]), (None, texts[5]), (None, None)]
    docs = spark.createDataFrame([(d, t, 7, "p", "n", 1) for d, t in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in alignment.align(docs, A, B, chunk, fan).collect()), key=str)
    assert got == _brute(rows)


def test_composing_is_associative():
    rnd = random.Random(2)
    for _ in range(200):
        parts = [(rnd.random() < 0.5, bytes([97 + k]), b"", 2 * k + 1) for k in range(rnd.randint(1, 7))]
        parts = [(c, x, x.upper() if c else b"", s) for c, x, _, s in parts]
        whole, joints = alignment.compose(parts)
        k = rnd.randint(0, len(parts))
        (left, a), (right, b) = alignment.compose(parts[:k]), alignment.compose(parts[k:])
        both, c = alignment.compose([x for x, n in ((left, k), (right, len(parts) - k)) if n])
        assert both == whole and sorted(a + b + c) == sorted(joints)


def test_no_rows(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), A, B).count() == 0
