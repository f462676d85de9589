"""Secret scans: fixed patterns plus a linear-chain conditional random field.

Tokens are tagged as begin, inside or outside of a secret from their shape,
their neighbours and features of the file; Viterbi finds the best tags.  Any
token may be tagged.  Scores of all tokens come from a table of the distinct
ones; Viterbi then leaves out only tokens that no path of the fitted model
could tag with profit.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import by_text, named_back, numbered

KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = "[A-Za-z0-9+/_.=-]"
_TOKEN = re.compile(rf"{_RUN}+|[^\sA-Za-z0-9+/_.=-]+")
_DIGIT = re.compile(r"[0-9]")
_SIGN = re.compile("[+/=_.-]")
_HEXED, _NUMBER = re.compile("[0-9a-f]+"), re.compile("[0-9.,-]+")
_SHAPES = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ" "abcdefghijklmnopqrstuvwxyz" "0123456789", "A" * 26 + "a" * 26 + "9" * 10)
_REPEAT = re.compile(r"(.)\1+")

AROUND = 6  # tokens on each side of a labelled secret that the model is fitted on
PIECE = 32  # tokens of a training piece
BUCKETS = 1 << 13  # hashed features
KNOWN = 200_000  # distinct tokens whose scores a task keeps
SAMPLE_DOCS = 2000  # documents that the model is fitted on, at most
RANKS = 1_000_000_007


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind."""
    spans = []
    low = text.lower()  # a quick look only; the pattern itself is ASCII
    if any(w in low for w in _ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if _DIGIT.search(text) or re.search("[a-f]{24}", text):
        spans += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


# ---- tokens and features

def tokens_of(text: str) -> list[tuple[str, int, int]]:
    return [(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text)]


def _entropy(token: str) -> float:
    n, signs = len(token), set(token)
    if len(signs) == n:
        return math.log2(n)
    counts = Counter(token).values() if n > 64 else [token.count(c) for c in signs]
    return math.log2(n) - sum(k * math.log2(k) for k in counts if k > 1) / n


def _look(token: str) -> tuple[str, ...]:
    """What a token says of itself, over its whole length; the first is its shape."""
    n, entropy = len(token), f"h={int(2 * _entropy(token))}"
    hexed = f"x={_HEXED.fullmatch(token) is not None}"
    if token.isascii() and token.islower() and token.isalpha():  # a plain word, in short
        return ("s=a+" if n > 1 else "s=a", f"n={min(n, 64) // 4}", entropy, "d=0", "u=FalseTrueFalse", hexed + "False")
    signs = token.translate(_SHAPES)
    digits = signs.count("9")
    return (
        "s=" + _REPEAT.sub(r"\1+", signs), f"n={min(n, 64) // 4}", entropy, f"d={digits * 8 // n}",
        f"u={'A' in signs}{'a' in signs}{_SIGN.search(token) is not None}", f"{hexed}{digits > 0 and _NUMBER.fullmatch(token) is not None}")


_NONE = ("s=", "", "", "", "", "")  # the look of a place beyond the ends


def _word(token: str) -> int:
    return xxhash.xxh32_intdigest(token.lower().encode("utf-8", "surrogatepass"))


def _before(word, k: int):
    """Bucket of a word `k` places before."""
    return (word ^ k * 0x1E3779B1) % BUCKETS


def _beside(look: tuple[str, ...]) -> list[int]:
    """Buckets of a shape just before and just after."""
    return [_bucket("-1" + look[0]), _bucket("+1" + look[0])]


def _of_file(token: str, file: tuple[str, ...]) -> list[str]:
    return [f"f={f}{len(token) >= 8}" for f in file]


N_FEATURES = 14


def _bucket(name: str) -> int:
    return xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass")) % BUCKETS


def features(tokens: list[str], file: tuple[str, ...], at: range | None = None) -> list[list[int]]:
    """Hashed features of the tokens `at` (all by default): shape, length, entropy, neighbours, file."""
    at = range(len(tokens)) if at is None else at
    looks = {i: _look(tokens[i]) for i in range(max(0, at.start - 3), min(len(tokens), at.stop + 1))}
    out = []
    for i in at:
        around = [_before(_word(tokens[i - k] if i >= k else ""), k) for k in (3, 2, 1)]
        around += [_beside(looks[j] if 0 <= j < len(tokens) else _NONE)[k] for k, j in enumerate((i - 1, i + 1))]
        out.append([_bucket("b"), *map(_bucket, looks[i]), *around, *map(_bucket, _of_file(tokens[i], file))])
    return out


def file_features(text: str) -> tuple[str, ...]:
    """Two coarse features of the whole text: share of signs, share of digits."""
    size = max(len(text), 1)
    signs = sum(text.count(c) for c in "#*$%&|<>{}();=")
    digits = sum(text.count(c) for c in "0123456789")
    return f"signs{min(9, signs * 50 // size)}", f"digits{min(9, digits * 50 // size)}"


# ---- the model

@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # features x tags
    moves: np.ndarray  # from tag x to tag


OUT, BEGIN, IN = range(3)
_BARRED = -1e9


def _pad(rows: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    made = np.zeros((len(rows), lengths.max(), N_FEATURES), dtype=np.int32)
    for i, r in enumerate(rows):
        made[i, :len(r)] = r
    return made, lengths


def _barred(moves: np.ndarray) -> np.ndarray:
    moves = moves.copy()
    moves[OUT, IN] = _BARRED  # inside follows begin or inside only
    return moves


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(rows: list[list[list[int]]], tags: list[list[int]], rounds: int = 60, decay: float = 1e-4) -> Model:
    """Maximum likelihood by forward-backward and Adam; the same rows give the same model."""
    x, lengths = _pad(rows)
    n, t = x.shape[:2]
    y = np.zeros((n, t), dtype=np.int64)
    for i, tag in enumerate(tags):
        y[i, :len(tag)] = tag
    inside = np.arange(t) < lengths[:, None]
    theta = [np.zeros((BUCKETS, 3)), np.zeros((3, 3))]
    first, second = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
    onehot = np.eye(3)[y] * inside[..., None]
    pair = np.zeros((3, 3))
    both = inside[:, 1:]
    np.add.at(pair, (y[:, :-1][both], y[:, 1:][both]), 1)
    for step in range(1, rounds + 1):
        emit = theta[0][x].sum(axis=2)
        moves = _barred(theta[1])
        a = np.zeros((n, t, 3))
        b = np.zeros((n, t, 3))
        a[:, 0] = emit[:, 0] + [0, 0, _BARRED]
        for k in range(1, t):
            a[:, k] = np.where(inside[:, k, None], _logsum(a[:, k - 1, :, None] + moves, 1) + emit[:, k], a[:, k - 1])
        for k in range(t - 2, -1, -1):
            b[:, k] = np.where(inside[:, k + 1, None], _logsum(moves + (emit[:, k + 1] + b[:, k + 1])[:, None, :], 2), 0)
        z = _logsum(a[np.arange(n), lengths - 1], 1)
        p = np.exp(a + b - z[:, None, None]) * inside[..., None]
        gap = onehot - p
        grad = np.zeros((BUCKETS, 3))
        for tag in range(3):
            grad[:, tag] = np.bincount(x.reshape(-1), np.repeat(gap[..., tag].reshape(-1), N_FEATURES), BUCKETS)
        edge = np.zeros((3, 3))
        for k in range(t - 1):
            joint = np.exp(np.minimum(a[:, k, :, None] + moves + (emit[:, k + 1] + b[:, k + 1])[:, None, :] - z[:, None, None], 0))
            edge += joint[inside[:, k + 1]].sum(axis=0)
        for j, g in enumerate((grad / n - decay * theta[0], (pair - edge) / n - decay * theta[1])):
            first[j] = 0.9 * first[j] + 0.1 * g
            second[j] = 0.999 * second[j] + 0.001 * g * g
            theta[j] += 0.1 * (first[j] / (1 - 0.9 ** step)) / (np.sqrt(second[j] / (1 - 0.999 ** step)) + 1e-8)
    return Model(theta[0], theta[1])


def viterbi(model: Model, emits: list[np.ndarray], cells: int = 200_000) -> list[np.ndarray]:
    """Best tags of each sequence from its scores (tokens x tags), in groups of like length."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(emits)
    order = sorted(range(len(emits)), key=lambda i: len(emits[i]))
    moves = _barred(model.moves)
    while order:
        take = 1
        while take < len(order) and (take + 1) * len(emits[order[take]]) <= cells:
            take += 1
        group, order = order[:take], order[take:]
        lengths = np.array([len(emits[i]) for i in group])
        n, t = len(group), int(lengths.max())
        emit = np.zeros((n, t, 3))
        for j, i in enumerate(group):
            emit[j, :lengths[j]] = emits[i]
        score = emit[:, 0] + [0, 0, _BARRED]
        back = np.zeros((n, t, 3), dtype=np.int8)
        for k in range(1, t):
            step = score[:, :, None] + moves
            back[:, k] = step.argmax(axis=1)
            live = (k < lengths)[:, None]
            score = np.where(live, step.max(axis=1) + emit[:, k], score)
            back[:, k] = np.where(live, back[:, k], np.arange(3))
        best = np.zeros((n, t), dtype=np.int64)
        best[:, -1] = score.argmax(axis=1)
        for k in range(t - 1, 0, -1):
            best[:, k - 1] = back[np.arange(n), k, best[:, k]]
        for j, i in enumerate(group):
            out[i] = best[j, :lengths[j]]
    return out


class _Ids(dict):
    """Numbers of the distinct tokens, in order of their first place."""

    def __init__(self, add):
        super().__init__()
        self.add = add

    def __missing__(self, token: str) -> int:
        i = self[token] = self.add(token)
        return i


class Scorer:
    """Scores of tokens under a model, from what the distinct ones met so far look like.

    Looks are few; each has a row with the weights of its own features and of
    its shape beside another token.  A text's scores are sums of such rows,
    shifted, and of the weights of the words before.
    """

    def __init__(self, model: Model):
        self.model = model
        moves, stay = model.moves, model.moves[OUT, OUT]
        inner = max(moves[BEGIN, BEGIN], moves[BEGIN, IN], moves[IN, BEGIN], moves[IN, IN]) - stay
        ends = max(moves[OUT, BEGIN] - stay, 0.0) + max(max(moves[BEGIN, OUT], moves[IN, OUT]) - stay, 0.0)  # no move before the first and after the last token
        self.inner, self.least = inner, inner - ends
        self._clear()

    def _clear(self) -> None:
        self.ids, self.looks = _Ids(self._add), {}
        self.rows: list[np.ndarray] = []  # of each look: own, before another, after another
        self.look: list[int] = []  # of each token
        self.word: list[int] = []
        self.long: list[bool] = []
        self.ids[""]

    def _add(self, token: str) -> int:
        look = _look(token) if token else _NONE
        at = self.looks.get(look)
        if at is None:
            at = self.looks[look] = len(self.rows)
            own = self.model.weights[[_bucket("b"), *map(_bucket, look)]].sum(axis=0)
            self.rows.append(np.concatenate([own[None], self.model.weights[_beside(look)]]))
        self.look.append(at)
        self.word.append(_word(token))
        self.long.append(len(token) >= 8)
        return len(self.look) - 1

    def emits(self, texts: list[list[str]], files: list[tuple[str, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the tokens of all texts in one array, and where each text begins; three empty places stand before each and one at the end."""
        if len(self.ids) > KNOWN:
            self._clear()
        row = []
        for tokens in texts:
            row += [0, 0, 0, *map(self.ids.__getitem__, tokens)]
        row = np.array([*row, 0], np.int64)
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(lengths + 3) - lengths
        table, look = np.stack(self.rows), np.array(self.look)[row]
        word = np.array(self.word, np.int64)[row]
        emit = table[look, 0]
        emit[1:] += table[look[:-1], 1]
        emit[:-1] += table[look[1:], 2]
        for k in (3, 2, 1):
            emit[k:] += self.model.weights[_before(word[:-k], k)]
        per_file = np.array([[self.model.weights[[_bucket(n) for n in _of_file(t, f)]].sum(axis=0) for t in ("", "long enough")] for f in files])
        which = np.repeat(np.arange(len(texts)), lengths + 3)
        emit[:-1] += per_file[which, np.array(self.long)[row[:-1]].astype(int)]
        emit[row == 0] = [0, _BARRED, _BARRED]  # tokens are never empty
        return emit, starts

    def runs(self, emit: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of tokens outside of which no path beats the same path with `outside` there.

        Tags on a run of tokens gain at most the sum of what each gains, with
        the best move inside, less `least`.  Such a sum can pass `least` only
        next to a token that gains on its own; sums are followed from there in
        both directions as long as they stay above zero.
        """
        gain = emit[:, 1:].max(axis=1) - emit[:, 0] + self.inner
        marked = np.zeros(len(gain), bool)
        seeds = np.flatnonzero(gain > min(self.least, 0.0))
        for step, order in ((1, seeds), (-1, seeds[::-1])):
            done = -1 if step > 0 else len(gain)
            for at in order.tolist():
                if (at - done) * step <= 0:
                    continue
                total, k = 0.0, at
                while 0 <= k < len(gain) and gain[k] > _BARRED / 2:
                    total = gain[k] + max(total, 0.0)
                    marked[k], done = True, k
                    if total <= 0 and k != at:
                        break
                    k += step
        edges = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
        return list(zip(edges[::2].tolist(), edges[1::2].tolist()))

    def tagged(self, emit: np.ndarray) -> list[tuple[int, int]]:
        """Secrets as (first token, last token + 1) of the array of scores."""
        runs = self.runs(emit)
        pieces, outs = [], []
        for start, end in runs:
            low, high = max(start - 1, 0), min(end + 1, len(emit))
            piece = emit[low:high].copy()
            left, right = emit[low, BEGIN] > _BARRED / 2, emit[high - 1, BEGIN] > _BARRED / 2
            # A neighbour in the text is outside; beyond its ends there is none.
            low, piece = (low, piece) if left or low == start else (low + 1, piece[1:])
            piece = piece if right or high == end else piece[:-1]
            if low < start:
                piece[0, BEGIN:] = _BARRED
            if low + len(piece) > end:
                piece[-1, BEGIN:] = _BARRED
            pieces.append(piece)
            outs.append(low)
        found = []
        for low, tags in zip(outs, viterbi(self.model, pieces)):
            for k, tag in enumerate(tags.tolist()):
                if tag == BEGIN:
                    found.append([low + k, low + k + 1])
                elif tag == IN:
                    found[-1][1] = low + k + 1
        return [(s, e) for s, e in found]


# ---- training rows

def _tag(tokens: list[tuple[str, int, int]], spans: list[tuple[int, int]]) -> list[int]:
    tags, last = [], None
    for _, start, end in tokens:
        hit = next((s for s in spans if s[0] < end and start < s[1]), None)
        tags.append(OUT if hit is None else IN if hit == last else BEGIN)
        last = hit
    return tags


def values(text: str) -> list[tuple[int, int]]:
    """Where the secrets of the fixed patterns stand, without the name that an assignment gives them."""
    starts = {m.start(): m.start(2) for m in _ASSIGN.finditer(text)}
    return [(starts[s] if kind == "assign" else s, e) for s, e, kind in base_spans(text)]


def training_rows(text: str, spans: list[tuple[int, int]], all_tokens: bool = False) -> list[tuple[list[list[int]], list[int]]]:
    """Features and tags of a text in successive pieces: of all of it, or of the tokens around secrets and long mixed tokens and of one more piece."""
    tokens, file = tokens_of(text), file_features(text)
    names, tags = [t[0] for t in tokens], _tag(tokens, spans)
    if all_tokens:
        wanted = np.ones(len(tokens), bool)
    else:
        centres = [i for i, t in enumerate(tokens) if tags[i] != OUT or len(t[0]) >= 8 and _DIGIT.search(t[0])]
        wanted = np.zeros(len(tokens), bool)
        for i in centres:
            wanted[max(0, i - AROUND):i + AROUND + 1] = True
        start = xxhash.xxh32_intdigest(text.encode("utf-8", "surrogatepass")) % max(1, len(tokens) - PIECE)
        wanted[start:start + PIECE] = True
    edges = np.flatnonzero(np.diff(np.r_[False, wanted, False].astype(np.int8)))
    pieces = [range(k, min(k + PIECE, e)) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()) for k in range(s, e, PIECE)]
    # A piece that begins inside a secret begins it for itself.
    return [(features(names, file, p), [BEGIN if j == 0 and tags[i] == IN else tags[i] for j, i in enumerate(p)]) for p in pieces]


def made_lines(count: int = 1400, seed: int = 7) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines with and without secrets, with and without digits, made by rule, so that a corpus without any still gives a model."""
    draw = random.Random(seed)
    pick = lambda signs, n: "".join(draw.choice(signs) for _ in range(n))
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    word = lambda: pick(lower, draw.randint(2, 9))
    long_word = lambda: pick(lower, draw.randint(8, 16))
    camel = lambda n: word() + "".join(word().capitalize() for _ in range(n))
    secret = (lambda: pick("0123456789abcdef", draw.choice((32, 40, 64))), lambda: pick(lower + upper + digits + "+/", 40),
              lambda: "ghp_" + pick(lower + upper + digits, 36), lambda: "sk-" + pick(lower + upper + digits, 32),
              lambda: "AKIA" + pick(upper + digits, 16), lambda: "eyJ" + pick(lower + upper + digits + "-_", 50),
              lambda: pick(lower + upper + digits, draw.randint(20, 32)), lambda: pick(lower + upper, draw.randint(24, 40)),
              lambda: pick(upper, draw.randint(24, 32)))
    named = (lambda: camel(draw.randint(3, 5)), lambda: pick(lower, draw.randint(24, 40)), lambda: "-".join(word() for _ in range(draw.randint(4, 6))))
    plain = (lambda: f"{draw.randint(1900, 2100)}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02}", lambda: pick(digits, draw.randint(8, 16)),
             lambda: f"{word()}{draw.randint(1, 999)}.{word()}", lambda: f"/{word()}/{word()}/{draw.randint(1, 9999)}",
             lambda: f"+{draw.randint(1, 99)}-{pick(digits, 3)}-{pick(digits, 4)}", lambda: f"{word()}.{draw.randint(1, 99)}/{word()}.example",
             lambda: ".".join(str(draw.randint(0, 255)) for _ in range(4)), lambda: f"{word()}-{word()}-{draw.randint(10, 9999)}",
             long_word, long_word, lambda: f"{word()} {long_word()}, {word()}.", lambda: camel(draw.randint(1, 5)), lambda: f"{word()}-{word()}",
             lambda: f"/{word()}/{word()}/{word()}.{word()}", lambda: f"{word()}.{word()}.example/{word()}", lambda: long_word().capitalize(),
             lambda: word().upper(), lambda: f"{word()}_{word()}_{word()}()", lambda: f"{word()}, {word()}; ({word()})")
    keys = ("token", "secret", "api_key", "key", "auth", "credential", "bearer", "client_secret", "access_key", "private_key", "passphrase", "password")
    lines = []
    for k in range(count):
        before, after = " ".join(word() for _ in range(draw.randint(0, 8))), " ".join(word() for _ in range(draw.randint(0, 8)))
        lead = draw.choice((f'{draw.choice(keys)} = "', f"{draw.choice(keys)}: ", f"export {draw.choice(keys).upper()}=", f"{draw.choice(keys)} ", ""))
        if k % 4 == 2:
            value = draw.choice(secret)()
        elif k % 4 == 3:
            value, lead = draw.choice(named if lead else secret)(), lead
        else:
            value, lead = draw.choice(plain)(), draw.choice(("", "", f"{word()} = ", f"{word()}: ", "id ", f"the {draw.choice(keys)} of "))
        head = f"{before} {lead}"
        lines.append((f"{head}{value} {after}", [(len(head), len(head) + len(value))] if k % 4 > 1 else []))
    return lines


def train(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on `sample_docs` documents at most (those of the smallest text hash) and on made lines.

    In the documents the fixed patterns are the labels.  Only hashed features
    of the tokens around labelled secrets and of one more piece of each text come to the driver.
    """
    schema = "rows array<struct<x: array<array<int>>, y: array<int>>>"
    kind = pa.list_(pa.struct([("x", pa.list_(pa.list_(pa.int32()))), ("y", pa.list_(pa.int32()))]))

    def run(texts: list[str | None]) -> dict[str, pa.Array]:
        made = []
        for t in texts:
            made.append([{"x": x, "y": y} for x, y in training_rows(t or "", values(t or ""))])
        return {"rows": pa.array(made, kind)}

    # A share of all texts by hash, so that few rows meet for the exact cut; copies count once.
    rank = F.pmod(F.xxhash64("_text"), F.lit(RANKS))
    most = RANKS if (rows := docs.count()) <= 2 * sample_docs else RANKS * 2 * sample_docs // rows
    sample = docs.select(docs[text].alias("_text")).filter(F.col("_text").isNotNull() & (rank < most)).distinct().orderBy(rank, "_text").limit(sample_docs)
    got = [(r["x"], r["y"]) for row in by_text(sample, [], "_text", schema, run).collect() for r in row["rows"]]
    got += [r for line, spans in made_lines() for r in training_rows(line, spans, True)]
    return fit(*(list(part) for part in zip(*got)))


# ---- the scan

def scan(texts: list[str | None], scorer: Scorer) -> list[list[tuple[int, int, str]]]:
    """All spans of each text: the fixed ones, and the model's where they meet none of these."""
    out = [base_spans(t or "") for t in texts]
    base = [list(o) for o in out]
    some = [i for i, t in enumerate(texts) if t and not t.isspace()]
    if not some:
        return out
    emit, starts = scorer.emits([_TOKEN.findall(texts[i]) for i in some], [file_features(texts[i]) for i in some])
    for first, last in scorer.tagged(emit):
        k = int(np.searchsorted(starts, first, "right")) - 1
        tokens = tokens_of(texts[some[k]])
        start, end = tokens[first - starts[k]][1], tokens[last - 1 - starts[k]][2]
        if not any(b[0] < end and start < b[1] for b in base[some[k]]):
            out[some[k]].append((start, end, "crf"))
    return [sorted(o, key=lambda s: (s[0], KINDS.index(s[2]))) for o in out]


_LAST: list[Scorer] = []


def _scorer(model: Model) -> Scorer:
    """The scorer of the model this Python process used last, so that its table serves all batches of a task."""
    if not _LAST or _LAST[0].model is not model:
        _LAST[:] = [Scorer(model)]
    return _LAST[0]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def secret_scan(docs: DataFrame, model: Model, keep: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the fixed kinds, their digest, all spans as kind:start:end.

    Offsets are code points, end exclusive.  Null and empty texts have no
    span (the digest of the empty string); repeated rows are scanned each;
    columns other than the two named are not read.
    """
    def run(texts: list[str | None]) -> dict[str, pa.Array]:
        found = scan(texts, _scorer(model))
        fixed = [[s for s in f if s[2] != "crf"] for f in found]
        counts = {f"n_{k}": pa.array([sum(s[2] == k for s in f) for f in fixed], pa.int64()) for k in KINDS[:3]}
        return counts | {"base_sha256": pa.array([hashlib.sha256(joined(f).encode()).hexdigest() for f in fixed]), "spans": pa.array([joined(f) for f in found])}

    return by_text(docs, [keep], text, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", run)


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with every stretch covered by spans replaced by one mark."""
    out, at = [], 0
    for s, e, _ in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: Model, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, each secret in the text replaced by `mark`; a null text stays null."""
    rows, (body,) = numbered(docs, text)

    def run(texts: list[str | None]) -> dict[str, pa.Array]:
        return {"_clean": pa.array([None if t is None else redact(t, s, mark) for t, s in zip(texts, scan(texts, _scorer(model)))], pa.string())}

    done = by_text(rows, [c for c in rows.columns if c != body], body, "_clean string", run).withColumnRenamed("_clean", body)
    return named_back(done, docs.columns)
