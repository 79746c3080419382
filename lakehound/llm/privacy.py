"""Op 13: personal data by patterns and a linear-chain conditional random field.

Base spans (e-mail, IP, card, phone) follow fixed patterns; each is found by runs
of bytes instead of a search engine, so a text takes time in proportion to its
length. The field reads word shapes: a token's classes of characters with its
length, its shape (runs of a class as one letter) and its word, of itself and
two neighbours on either side. It is trained by its likelihood on a small
labelled table and decoded exactly: where no neighbours could make another label
than OTHER win, OTHER is certain; the runs between are decoded by Viterbi in
numpy batches. What it finds beside the base spans is added to them.
"""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehound.llm import words as W

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = 4
LABELS = (*KINDS, "other")
OTHER = len(KINDS)
#: Labelled rows that the field is trained on at most (the smallest hashes of the text).
LABELLED_ROWS = 4096
REACH, LENGTHS = 2, (1, 2, 3, 4, 6, 8, 12, 15, 19, 31)
STEPS, RATE = 150, 0.15
#: Penalties of unary and of transition weights; the larger one keeps what neighbours can gain small.
PENALTY, PAIR_PENALTY = 0.003, 1.0
#: Bytes between two tokens of one span at most.
GAP = 3


def _table(*spans: str) -> np.ndarray:
    """A mask of bytes from ranges like ``a-z`` or single characters."""
    out = np.zeros(256, dtype=bool)
    for s in spans:
        out[ord(s[0]):ord(s[-1]) + 1] = True
    return out


_DIGIT, _UPPER, _LOWER = _table("0-9"), _table("A-Z"), _table("a-z") | (np.arange(256) >= 128)
_LOCAL = _table("A-Z", "a-z", "0-9", ".", "_", "%", "+", "-")
_CALL = _table("0-9", " ", "(", ")", ".", "-")
_ALNUM = _DIGIT | _UPPER | _LOWER
_JOIN = _table(".", "_", "%", "+", "-", "@")
_DOMAIN = regex.compile(rb"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Classes of bytes in a shape: upper, lower, digit, at, dot, other.
_CLASS = np.full(256, 5, dtype=np.uint8)
for _k, _mask in enumerate((_UPPER, _LOWER, _DIGIT, _table("@"), _table("."))):
    _CLASS[_mask] = _k


def _runs(text: W.Text, mask: np.ndarray) -> W.Words:
    return W.split(text, ~mask)


def _chains(runs: W.Words, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last run of each chain; ``joined[i]`` ties runs i and i + 1."""
    head = np.flatnonzero(np.append(True, ~joined)) if len(runs.starts) else np.zeros(0, np.int64)
    return head, np.append(head[1:], len(runs.starts))


def luhn(digits: bytes) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = (d - 48) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: W.Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kind, row, start, end) in bytes of the base spans of a slice, by kind, then place."""
    data, raw = text.data, text.data.tobytes()
    found: list[tuple[int, int, int, int]] = []

    local, last = _runs(text, _LOCAL), 0
    for at in np.flatnonzero(data == ord("@")).tolist():
        k = int(np.searchsorted(local.ends, at))
        if k == len(local.ends) or local.ends[k] != at:
            continue
        row = int(local.row[k])
        start = max(int(local.starts[k]), last)
        domain = _DOMAIN.match(raw, at + 1, int(text.offsets[row + 1]))
        if start < at < text.offsets[row + 1] and domain:
            found.append((0, row, start, domain.end()))
            last = domain.end()

    digits = _runs(text, _DIGIT)
    n = len(digits.starts)
    near = (digits.starts[1:] == digits.ends[:-1] + 1) & (digits.row[1:] == digits.row[:-1]) if n else np.zeros(0, bool)
    between = data[digits.ends[:-1]] if n > 1 else np.zeros(0, np.uint8)
    if n:
        for head, end in zip(*_chains(digits, near & (between == ord("."))), strict=True):
            for k in range(int(head), int(end) - 3, 4):
                parts = [raw[i:j].lstrip(b"0") for i, j in zip(digits.starts[k:k + 4].tolist(), digits.ends[k:k + 4].tolist(), strict=True)]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    found.append((1, int(digits.row[k]), int(digits.starts[k]), int(digits.ends[k + 3])))
        head, end = _chains(digits, near & ((between == ord(" ")) | (between == ord("-"))))
        size = np.append(0, np.cumsum(digits.ends - digits.starts))
        size = size[end] - size[head]
        for h, e in zip(head[(size >= 13) & (size <= 19)].tolist(), end[(size >= 13) & (size <= 19)].tolist(), strict=True):
            start, stop = int(digits.starts[h]), int(digits.ends[e - 1])
            if luhn(raw[start:stop].translate(None, b" -")):
                found.append((2, int(digits.row[h]), start, stop))

    plus = np.flatnonzero(data[:-1] == ord("+")) if len(data) else np.zeros(0, np.int64)
    plus = plus[_DIGIT[data[plus + 1]]]
    call = _runs(text, _CALL)
    before = np.append(0, np.cumsum(_DIGIT[data]))
    places = np.flatnonzero(_DIGIT[data])
    row_of = np.searchsorted(text.offsets, plus, side="right") - 1
    for p, row in zip(plus.tolist(), row_of.tolist(), strict=True):
        k = int(np.searchsorted(call.starts, p + 1))
        if k == len(call.starts) or call.starts[k] != p + 1 or call.row[k] != row:
            continue
        end = int(places[before[int(call.ends[k])] - 1]) + 1
        if end - p >= 4 and 9 <= before[end] - before[p] <= 15:
            found.append((3, row, p, end))
    out = np.array(found, dtype=np.int64).reshape(-1, 4)
    return out[:, 0], out[:, 1], out[:, 2], out[:, 3]


@dataclass
class Tokens:
    """Tokens of a slice, with the codes of their classes and length, their shapes and words."""

    at: W.Words
    code: np.ndarray
    shape: np.ndarray
    word: np.ndarray


def tokens(text: W.Text) -> Tokens:
    """Runs of letters and digits; ``._%+-@`` between two of them, and a plus before one, belong to the token."""
    data = text.data
    alnum = _ALNUM[data]
    before, after = np.append(False, alnum[:-1]), np.append(alnum[1:], False)
    if len(data):
        edge = text.offsets[(text.offsets > 0) & (text.offsets < len(data))]
        before[edge], after[edge - 1] = False, False
    inside = alnum | (_JOIN[data] & before & after) | ((data == ord("+")) & after)
    marks = W.Text(inside.astype(np.uint8), text.offsets)
    at = W.split(marks, np.arange(256) == 0)
    # letters beyond ASCII, which have no case here, count only in tokens of nothing else
    ascii_ = np.flatnonzero(inside & (data < 128))
    kind = _CLASS[data[ascii_]]
    starts, ends = np.searchsorted(ascii_, at.starts), np.searchsorted(ascii_, at.ends)
    have = np.zeros(len(at.starts), dtype=np.int64)
    for k in range(6):
        total = np.append(0, np.cumsum(kind == k))
        have |= (total[ends] > total[starts]).astype(np.int64) << k
    size = np.searchsorted(LENGTHS, at.ends - at.starts)
    # a shape keeps one byte of each run of a class inside its token
    first = np.zeros(len(kind) + 1, dtype=bool)
    first[starts] = True
    keep = first[:-1] | np.append(True, kind[1:] != kind[:-1])[:len(kind)]
    place = np.append(0, np.cumsum(keep))
    marked = (kind + np.where(kind == 5, data[ascii_], 0).astype(np.uint8))[keep]
    shape = W.spans_hash(marked, place[starts], place[ends])
    shape[have == 0], have[have == 0] = W.spans_hash(np.array([1], np.uint8), np.array([0]), np.array([1]))[0], 2
    word = W.spans_hash(W.LOWER[data], at.starts, at.ends)
    return Tokens(at, have * (len(LENGTHS) + 1) + size, shape, word)


CODES = 64 * (len(LENGTHS) + 1)


@dataclass
class Field:
    """Weights of a trained field: for each neighbour's place, of codes, known shapes and known words."""

    shapes: np.ndarray      # sorted
    known: np.ndarray       # sorted word values
    unary: np.ndarray       # (places, features, labels): codes, shapes, "no known shape", words, "no known word"
    pairs: np.ndarray       # (labels, labels)
    ends: np.ndarray        # (2, labels): at a text's first and last token

    def features(self, t: Tokens) -> np.ndarray:
        """(3, tokens): places in ``unary`` of the code, shape and word of each."""
        out = np.empty((3, len(t.code)), dtype=np.int64)
        out[0], base = t.code, CODES
        for k, (values, table) in enumerate(((t.shape, self.shapes), (t.word, self.known)), 1):
            out[k] = base + len(table)
            if len(table):
                spot = np.minimum(np.searchsorted(table, values), len(table) - 1)
                out[k] = np.where(table[spot] == values, base + spot, out[k])
            base += len(table) + 1
        return out

    def scores(self, t: Tokens) -> np.ndarray:
        """Unary scores (tokens, labels): tokens of equal features share what they add to their neighbours'."""
        features, n = self.features(t), len(t.code)
        key = (features[0] * (len(self.shapes) + 1) + features[1] - CODES) * (len(self.known) + 1) + features[2]
        _, where, kind = np.unique(key, return_index=True, return_inverse=True)
        out = np.zeros((n, len(LABELS)))
        for place in range(-REACH, REACH + 1):
            parts = self.unary[place + REACH][features[:, where]].sum(axis=0)
            parts = np.vstack([parts, np.zeros((1, len(LABELS)))])
            near = np.arange(n) + place
            ok = (near >= 0) & (near < n)
            near = np.where(ok, near, 0)
            ok &= t.at.row[near] == t.at.row
            out += parts[np.where(ok, kind[near], len(where))]
        return out

    def margin(self) -> np.ndarray:
        """What another label can gain over OTHER by its neighbours, at most."""
        into = (np.vstack([self.pairs, self.ends[:1]]) - np.vstack([self.pairs, self.ends[:1]])[:, [OTHER]]).max(axis=0)
        out = np.vstack([self.pairs.T, self.ends[1:]])
        gain = into + (out - out[:, [OTHER]]).max(axis=0)
        gain[OTHER] = -np.inf
        return gain

    def decode(self, t: Tokens) -> np.ndarray:
        """The likeliest labels of all rows' tokens."""
        n, row = len(t.code), t.at.row
        labels = np.full(n, OTHER, dtype=np.int64)
        if not n:
            return labels
        scores, gain, at = self.scores(t), self.margin(), np.arange(n)
        open_ = (scores + gain).max(axis=1) >= scores[:, OTHER]
        at, scores = at[open_], scores[open_]
        if not len(at):
            return labels
        head = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])))
        size = np.diff(np.append(head, len(at)))
        first = (at[head] == 0) | (row[at[head] - 1] != row[at[head]])
        tail = at[head + size - 1]
        last = (tail == n - 1) | (row[np.minimum(tail + 1, n - 1)] != row[tail])
        enter = np.where(first[:, None], self.ends[0], self.pairs[OTHER])
        leave = np.where(last[:, None], self.ends[1], self.pairs[:, OTHER])
        order = np.argsort(size, kind="stable")
        start = 0
        while start < len(order):  # runs of like length together
            stop = int(np.searchsorted(size[order], 2 * size[order[start]], side="right"))
            stop = min(stop, start + max(1, (1 << 18) // int(size[order[stop - 1]])))
            own = order[start:stop]
            self._viterbi(scores, head[own], size[own], enter[own], leave[own], at, labels)
            start = stop
        return labels

    def _viterbi(self, scores: np.ndarray, head: np.ndarray, size: np.ndarray, enter: np.ndarray, leave: np.ndarray,
                 at: np.ndarray, labels: np.ndarray) -> None:
        """Label the runs of tokens that begin at ``head``, all in step."""
        most, k = int(size.max()), len(LABELS)
        best = enter + scores[head]
        back = np.zeros((most, len(head), k), dtype=np.int8)
        final = best + leave
        for i in range(1, most):
            on = size > i
            ways = best[:, :, None] + self.pairs
            back[i] = ways.argmax(axis=1)
            best = np.where(on[:, None], ways.max(axis=1) + scores[np.minimum(head + i, len(scores) - 1)], best)
            final = np.where(on[:, None], best + leave, final)
        label = final.argmax(axis=1)
        for i in range(most - 1, -1, -1):
            on = size > i
            labels[at[(head + i)[on]]] = label[on]
            if i:
                label = np.where(on, back[i, np.arange(len(head)), label], label)


def train(rows: list[tuple[str, list[tuple[str, int, int]]]]) -> Field:
    """The field of labelled ``rows``: (text, [(kind, start, end)]) in code points."""
    texts = [t.encode() for t, _ in rows]
    text = W.Text(np.frombuffer(b"".join(texts), dtype=np.uint8), np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64))
    t = tokens(text)
    n, labels = len(t.code), np.full(len(t.code), OTHER)
    for i, (own, spans) in enumerate(rows):
        for kind, start, end in spans:
            a, b = (len(own[:x].encode()) + text.offsets[i] for x in (start, end))
            labels[(t.at.row == i) & (t.at.starts < b) & (t.at.ends > a)] = KINDS.index(kind)
    spanned = np.flatnonzero(labels != OTHER)
    close = np.unique(np.concatenate([spanned + k for k in range(-REACH, REACH + 1)])) if len(spanned) else spanned
    close = close[(close >= 0) & (close < n)]
    close = close[labels[close] == OTHER]
    often = Counter(t.word[close].tolist())
    common = Counter(t.shape.tolist())
    known = np.array(sorted(w for w, c in often.items() if c >= 8), dtype=np.uint64)
    shapes = np.array(sorted(s for s, c in common.items() if c >= 3), dtype=np.uint64)
    size, k = CODES + len(shapes) + len(known) + 2, len(LABELS)
    field = Field(shapes, known, np.zeros((2 * REACH + 1, size, k)), np.zeros((k, k)), np.zeros((2, k)))
    if not n:
        return field
    features = field.features(t)
    first = t.at.first
    sizes = np.diff(first)
    use = np.flatnonzero(sizes > 0)
    first, sizes = first[:-1][use], sizes[use]
    wide = int(sizes.max())
    grid = first[:, None] + np.minimum(np.arange(wide), sizes[:, None] - 1)
    on = np.arange(wide) < sizes[:, None]
    # every token's features in ``unary`` as one flat index; none where there is no neighbour
    spots = []
    for place in range(-REACH, REACH + 1):
        near = np.arange(n) + place
        ok = (near >= 0) & (near < n)
        near = np.where(ok, near, 0)
        ok &= t.at.row[near] == t.at.row
        spots += [(place + REACH, f[near], ok) for f in features]
    truth = np.eye(k)[labels]
    starts, tails = first, first + sizes - 1
    pair_truth = np.zeros((k, k))
    inner = np.flatnonzero(t.at.row[1:] == t.at.row[:-1])
    np.add.at(pair_truth, (labels[inner], labels[inner + 1]), 1)
    params = [field.unary, field.pairs, field.ends]
    speed, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        score = np.zeros((n, k))
        for place, f, ok in spots:
            score[ok] += field.unary[place][f[ok]]
        unary, pair = _expected(score[grid], on, sizes, field)
        got = np.zeros((n, k))
        got[grid[on]] = unary[on]
        diff = truth - got
        grad = [np.zeros_like(field.unary), pair_truth - pair, np.stack([diff[starts].sum(axis=0), diff[tails].sum(axis=0)])]
        for place, f, ok in spots:
            for y in range(k):
                grad[0][place, :, y] += np.bincount(f[ok], weights=diff[ok, y], minlength=size)
        for p, g, v, s, penalty in zip(params, grad, speed, square, (PENALTY, PAIR_PENALTY, PAIR_PENALTY), strict=True):
            g -= penalty * p
            v += 0.1 * (g - v)
            s += 0.01 * (g * g - s)
            p += RATE * (v / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return field


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def _expected(score: np.ndarray, on: np.ndarray, sizes: np.ndarray, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all labels, and expected transitions, by forward and backward sums over padded texts."""
    rows, wide, k = score.shape
    ahead, behind = np.zeros((wide, rows, k)), np.zeros((wide, rows, k))
    ahead[0] = score[:, 0] + field.ends[0]
    for i in range(1, wide):
        step = _log_sum(ahead[i - 1][:, :, None] + field.pairs, 1) + score[:, i]
        ahead[i] = np.where(on[:, i, None], step, ahead[i - 1])
    total = _log_sum(ahead[-1] + field.ends[1], 1)
    behind[-1] = field.ends[1]
    for i in range(wide - 2, -1, -1):
        step = _log_sum(field.pairs + (score[:, i + 1] + behind[i + 1])[:, None, :], 2)
        behind[i] = np.where(on[:, i + 1, None], step, field.ends[1])
    unary = np.exp(ahead + behind - total[None, :, None]).transpose(1, 0, 2)
    pair = np.zeros((k, k))
    for i in range(1, wide):
        live = on[:, i]
        p = ahead[i - 1][live][:, :, None] + field.pairs + (score[live, i] + behind[i][live])[:, None, :] - total[live][:, None, None]
        pair += np.exp(p).sum(axis=0)
    return unary, pair


#: Frames of labelled lines, {kind} marks a value, {x} words, {n} harmless numbers.
FRAMES = (
    "{x} {email} {x}", "contact {email} or {phone} {x}", "{x} mail: {email}, {x}", "{x} {phone} {x}", "call {phone} {x} {n} {x}",
    "{x} {phone} {card} {x}", "{x} {card} {phone} {x}", "{x} {card} {ip} {x}", "{x} {ip} {card} {x}", "{x} {phone} {ip} {x}",
    "{x} {ip} {phone} {x}", "{x} {email} {phone} {card} {ip} {x}", "{x} {phone} {card} {ip} {x}", "{x} {card} {x}", "{x}. {ip} {x}",
    "card {card} {x} {n} {x}", "{x} from {ip} {x}", "{x} {email} {ip} {x}", "{x} password={secret} {x}", "{x} token = \"{secret}\" {x}",
    "{x} {secret} {x}", "api key: {secret} {x}", "secret {secret} {x}", "{x} {phone} {phone} {x}", "{x} {card} {card} {x}",
    "tel {phone}. {x}", "{x} {n} {phone}", "{x} {n} {x} {n} {x}", "{x}", "{x} {x} {n}", "{n} {x}", "version {n} {x}", "{x}### {n}$$$ {x}&&&",
    "{x} {n} {card} {n} {x}", "{x}, {x} in {n}", "licensed under {n} {x} {n}", "{n}", "{x} {email}", "{ip} {x}", "{phone} {x}", "{card} {x}",
)
#: Words of the labelled lines.
FILLER = ("the of and to in is that for it with as was on by this are from at an be der die und das von mit nicht auf ein ist la de que el los "
          "por una con para est les des une dans pour sur pas qui été niño größe ñ à 漢字 être house river stone Water Green Maria Berlin London Paris "
          "Report Section table value people company letter number").split()


def _value(rnd: random.Random, kind: str) -> str:
    def digits(n: int) -> str:
        return "".join(rnd.choice("0123456789") for _ in range(n))

    def letters(n: int, of: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        return "".join(rnd.choice(of) for _ in range(n))

    if kind == "email":
        user = rnd.choice([letters(5), letters(4) + "." + letters(6), letters(5) + "." + digits(2), letters(3) + "_" + digits(3), letters(1).upper() + letters(5)])
        return f"{user}@{letters(5)}{rnd.choice(['', digits(1)])}.{rnd.choice(['example.com', 'example.org', 'com', 'co.uk', 'de'])}"
    if kind == "ip":
        return ".".join(str(rnd.randint(0, 255)) for _ in range(4))
    if kind == "card":
        number = rnd.choice("3456") + digits(rnd.choice([14, 14, 14, 13, 17]))
        number += next(str(d) for d in range(10) if luhn((number + str(d)).encode()))
        return number if rnd.random() < 0.7 or len(number) != 16 else rnd.choice(" -").join(number[i:i + 4] for i in range(0, 16, 4))
    if kind == "phone":
        return rnd.choice([f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"+1 ({digits(3)}) 555-{digits(4)}", f"+1 {digits(3)}-{digits(3)}-{digits(4)}",
                           f"+49 {digits(3)} {digits(7)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"+33 1 {digits(2)} {digits(2)} {digits(2)} {digits(2)}"])
    if kind == "secret":
        return rnd.choice([letters(40, "0123456789abcdef"), letters(18, "0123456789abcdef"), "AKIA" + letters(16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
                           letters(32, "0123456789abcdef"), letters(24, "ABCDEFGHabcdefgh0123456789")])
    if kind == "n":
        return rnd.choice([digits(1), digits(2), digits(3), str(rnd.randint(1900, 2030)), digits(5), f"{digits(1)}.{digits(1)}", f"{digits(2)}.{digits(2)}",
                           f"{digits(1)}.{digits(1)}.{digits(1)}", f"{digits(2)}:{digits(2)}", f"2024-0{rnd.randint(1, 9)}-{rnd.randint(10, 28)}",
                           f"{digits(1)},{digits(3)}", f"{digits(2)}%", f"A{digits(2)}", f"{letters(3)}{digits(1)}", f"{digits(1)}.", f"{digits(3)}-{digits(2)}",
                           f"{letters(2).upper()}-{letters(2).upper()}", f"{letters(4)}-{letters(5)}", f"{letters(6).title()}.{letters(5)}", f"www.{letters(5)}.com",
                           f"{letters(3)}_{letters(4)}", f"{digits(2)}-{digits(2)}", f"{letters(1).upper()}{letters(2)}{letters(2).upper()}", f"+{digits(2)}%"])
    text = " ".join(letters(rnd.randint(2, 40)) if rnd.random() < 0.1 else rnd.choice(FILLER) for _ in range(rnd.randint(1, 6)))
    case = rnd.random()
    text = text.upper() if case < 0.15 else text.title() if case < 0.25 else text
    return text + rnd.choice(["", "", ".", ","])


def labelled_table(spark: SparkSession, copies: int = 8) -> DataFrame:
    """A small labelled table (text, spans): frames, and as many random runs of slots, ``copies`` times with values made by rule."""
    rnd, rows = random.Random(13), []
    slots = ["{x}"] * 6 + ["{n}"] * 3 + [f"{{{k}}}" for k in KINDS]
    mixed = [" ".join(rnd.choice(slots) for _ in range(rnd.randint(2, 9))) for _ in range(copies * len(FRAMES))]
    for frame in [*FRAMES * copies, *mixed]:
        text, spans = "", []
        for part in regex.split(r"(\{[a-z]+\})", frame):
            kind = part[1:-1] if part.startswith("{") else None
            value = _value(rnd, kind) if kind else part
            if kind in KINDS:
                spans.append((kind, len(text), len(text) + len(value)))
            text += value
        rows.append((text, spans))
    return spark.createDataFrame(rows, "text string, spans array<struct<kind: string, start: int, end: int>>")


def fitted(labelled: DataFrame) -> Field:
    """The field of ``labelled`` (text, spans), of at most LABELLED_ROWS rows; null texts and spans teach nothing."""
    rows = labelled.filter("text is not null and spans is not null").select("text", "spans").orderBy(F.xxhash64("text"), "text").limit(LABELLED_ROWS)
    return train([(r.text, [(s.kind, s.start, s.end) for s in r.spans if s.kind in KINDS]) for r in rows.collect()])


def field_spans(text: W.Text, field: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kind, row, start, end) in bytes of the field's spans: runs of tokens of one label, close together in a line."""
    t = tokens(text)
    labels = field.decode(t)
    at = np.flatnonzero(labels != OTHER)
    starts, ends, row = t.at.starts[at], t.at.ends[at], t.at.row[at]
    lines = np.append(0, np.cumsum(text.data == 10))
    if not len(at):
        return at, at, at, at
    same = (at[1:] == at[:-1] + 1) & (labels[at[1:]] == labels[at[:-1]]) & (row[1:] == row[:-1]) & (starts[1:] - ends[:-1] <= GAP)
    same &= lines[starts[1:]] == lines[ends[:-1]]
    head = np.flatnonzero(np.append(True, ~same))
    tail = np.append(head[1:], len(at)) - 1
    return labels[at[head]], row[head], starts[head], ends[tail]


def _overlapping(starts: np.ndarray, ends: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Which spans meet one of the others."""
    return np.searchsorted(np.sort(other_starts), ends, side="left") > np.searchsorted(np.sort(other_ends), starts, side="right")


RESULT = [*(f"n_{k}" for k in KINDS[:BASE]), "base_sha256", "spans"]


def _written(rows: int, spans: tuple[np.ndarray, ...], before: np.ndarray, offsets: np.ndarray) -> list[str]:
    """``kind:start:end`` of every row's spans in code points, by kind, then start."""
    kind, row, start, end = spans
    order = np.lexsort((start, kind, row))
    shift = before[offsets[row]]
    out: list[list[str]] = [[] for _ in range(rows)]
    columns = (x[order].tolist() for x in (kind, row, before[start] - shift, before[end] - shift))
    for k, r, a, b in zip(*columns, strict=True):
        out[r].append(f"{KINDS[k]}:{a}:{b}")
    return [",".join(x) for x in out]


def scan(text: W.Text, field: Field) -> dict[str, list]:
    """The result columns of the rows of a slice."""
    base = base_spans(text)
    more = field_spans(text, field)
    new = ~_overlapping(more[2], more[3], base[2], base[3])
    every = tuple(np.concatenate([x, y[new]]) for x, y in zip(base, more, strict=True))
    before = np.append(0, np.cumsum((text.data & 0xC0) != 0x80))
    written = _written(text.rows, base, before, text.offsets)
    out = {f"n_{k}": np.bincount(base[1][base[0] == i], minlength=text.rows) for i, k in enumerate(KINDS[:BASE])}
    return out | {"base_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in written], "spans": _written(text.rows, every, before, text.offsets)}


def find_private(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Personal data in every row of ``docs`` (doc_id, text), by base patterns and a field trained on ``labelled``.

    Null texts are empty: no spans. Texts are read whole, whatever their length; repeated rows are judged
    each. Spans of the field that meet a base span are left out; kinds beyond the four base ones stand
    behind them. An empty ``labelled`` table adds nothing. Other columns are not used.
    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans.
    """
    rows = docs.select("doc_id", "text")
    field = fitted(labelled if labelled is not None else labelled_table(docs.sparkSession))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in W.slices(batches, "text"):
            found = scan(text, field)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(found[c]) for c in RESULT]], names=["doc_id", *RESULT])

    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in RESULT[:BASE]],
                           *[T.StructField(c, T.StringType()) for c in RESULT[BASE:]]])
    return rows.mapInArrow(scanned, schema)
