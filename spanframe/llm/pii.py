"""Personal data: exact patterns, and a character-level bidirectional LSTM with a CRF that adds to them.

The tagger is trained in numpy, from texts with labelled spans. Every position of a text lies in
overlapping windows; the tag scores of its windows are merged, by how far it is from their ends, and
one Viterbi path over the whole text reconciles them. Tagged spans count only if they pass their
kind's own checks (digits, Luhn, parts, shape) and overlap no exact match. Beside written forms that
the patterns miss, the tagger finds secrets (tokens, keys and passwords), a kind of its own.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

BASE_KINDS = ("email", "ip", "card", "phone")
#: The kinds of the tagger, in the order in which spans are told.
KINDS = (*BASE_KINDS, "secret")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What each plausible span has: a digit, an @, or either in words.
_NEEDED = re.compile(r"[0-9@]|[\[({]\s?at\s?[\])}]|\sdot\s")
_WRITTEN = re.compile(
    r"[A-Za-z0-9._%+-]+(?:(?:\s?@\s?|\s?[\[({]\s?at\s?[\])}]\s?)[A-Za-z0-9-]+(?:(?:\s?\.\s?|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)[A-Za-z0-9-]+)+"
    r"|\sat\s[A-Za-z0-9-]+(?:\sdot\s[A-Za-z0-9-]+)+)"
)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Exact matches, leftmost and non-overlapping for each kind, by kind and start; in linear time."""
    out = []
    if "@" in text:
        last = 0
        for m in _AT.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                last = m.end()
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def plausible(kind: str, s: str) -> bool:
    """Whether a tagged span passes the checks of its kind."""
    d = _digits(s)
    if kind == "email":
        return _WRITTEN.fullmatch(s) is not None
    if kind == "secret":
        return re.fullmatch(r"[A-Za-z0-9_+/=-]{16,}", s) is not None and len(d) >= 2 and sum(c.isalpha() for c in s) >= 2
    if kind == "ip":
        parts = re.split(r"\s*(?:\.|\[\.\]|\(\.\))\s*", s)
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in parts)
    if kind == "card":
        return re.fullmatch(r"[0-9][0-9 ./_-]*[0-9]", s) is not None and 16 <= len(d) <= 19 and luhn(d)
    return re.fullmatch(r"[+(0-9][0-9 ()./-]*[0-9]", s) is not None and 8 <= len(d) <= 15 and len(re.findall(r"[ ()./-]+", s)) >= 2 and not re.search(r"[0-9]{7}", s)


#: Symbols of the tagger: line feed (and what is outside of the text), each printable ASCII character, and six groups of others.
SYMBOLS, EDGE = 1 + 95 + 6, 0


@functools.lru_cache(maxsize=1)
def _symbol_table() -> np.ndarray:
    other = 1 + 95
    found = np.full(0x251, other + 5, np.uint8)
    for c in range(len(found) - 1):
        x = chr(c)
        if 0x20 <= c < 0x7F:
            found[c] = c - 0x1F
        elif x == "\n":
            found[c] = EDGE
        elif x.isspace():
            found[c] = other
        elif x.isdigit():
            found[c] = other + 1
        elif x.isalpha():
            found[c] = other + (2 if x.islower() else 3)
    found[0x250] = other + 4  # all that is beyond the Latin letters
    return found


def symbols_of(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _symbol_table()[np.minimum(c, 0x250)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Tagger:
    """Parameters by name: for each direction the symbols' table `x` and recurrence `h`; `out`, `bias`, `move`, `start`."""

    p: dict[str, np.ndarray]
    size: int

    @staticmethod
    def new(size: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.3, (SYMBOLS, 4 * size))
            p[f"x{d}"][:, size : 2 * size] += 1  # forget gates open
            p[f"h{d}"] = rng.normal(0, 0.3, (size, 4 * size))
        p["out"], p["bias"] = rng.normal(0, 0.3, (2 * size, TAGS)), np.where(np.arange(TAGS) == 0, 3.0, 0.0)
        p["move"], p["start"] = np.zeros((TAGS, TAGS)), np.zeros(TAGS)
        return Tagger({k: v.astype(np.float32) for k, v in p.items()}, size)

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (time, batch, size) of one direction, and what the way back needs."""
        n, s = x.shape[1], self.size
        h, c = np.zeros((n, s), np.float32), np.zeros((n, s), np.float32)
        hs, kept = np.empty((len(x), n, s), np.float32), []
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            z = self.p[f"x{d}"][x[t]] + h @ self.p[f"h{d}"]
            z[:, : 3 * s] = _sigmoid(z[:, : 3 * s])
            i, f, o, g = z[:, :s], z[:, s : 2 * s], z[:, 2 * s : 3 * s], np.tanh(z[:, 3 * s :])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep:
                kept.append((t, h, before, i, f, o, g, tc))
            h = o * tc
            hs[t] = h
        return hs, kept

    def _back(self, x: np.ndarray, d: str, kept: list, dhs: np.ndarray, grad: dict) -> None:
        s = self.size
        dh, dc = np.zeros_like(dhs[0]), np.zeros_like(dhs[0])
        told = np.empty((*x.shape, 4 * s), dhs.dtype)
        for t, h, before, i, f, o, g, tc in reversed(kept):
            dh = dh + dhs[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            told[t] = dz
            grad[f"h{d}"] += h.T @ dz
            dh, dc = dz @ self.p[f"h{d}"].T, dc * f
        which = (x.reshape(-1)[None, :] == np.arange(SYMBOLS)[:, None]).astype(dhs.dtype)
        grad[f"x{d}"] += which @ told.reshape(-1, 4 * s)

    def emissions(self, x: np.ndarray, keep: bool = False):
        """Tag scores (time, batch, tags) of symbol sequences (time, batch)."""
        hf, kf = self._run(x, "f", keep)
        hb, kb = self._run(x, "b", keep)
        h = np.concatenate([hf, hb], 2)
        return h @ self.p["out"] + self.p["bias"], h, kf, kb

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tag sequences under the CRF, and its gradient."""
        e, h, kf, kb = self.emissions(x, True)
        move, n, size = self.p["move"], x.shape[1], len(x)
        up, down = np.empty_like(e), np.zeros_like(e)
        up[0] = self.p["start"] + e[0]
        lse = lambda a, axis: a.max(axis) + np.log(np.exp(a - a.max(axis, keepdims=True)).sum(axis))
        for t in range(1, size):
            up[t] = lse(up[t - 1][:, :, None] + move, 1) + e[t]
        for t in range(size - 2, -1, -1):
            down[t] = lse(move + (e[t + 1] + down[t + 1])[:, None, :], 2)
        z = lse(up[-1], 1)
        rows = np.arange(n)
        score = self.p["start"][y[0]] + e[np.arange(size)[:, None], rows, y].sum(0) + move[y[:-1], y[1:]].sum(0)
        de = np.exp(up + down - z[:, None])
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["start"] = de[0].sum(0) - np.bincount(y[0], minlength=TAGS)
        grad["move"] += np.exp(up[:-1, :, :, None] + move + (e[1:] + down[1:])[:, :, None, :] - z[:, None, None]).sum((0, 1))
        grad["move"] -= np.bincount((y[:-1] * TAGS + y[1:]).ravel(), minlength=TAGS * TAGS).reshape(TAGS, TAGS)
        de[np.arange(size)[:, None], rows, y] -= 1
        grad["bias"] = de.sum((0, 1))
        grad["out"] = np.einsum("tnh,tnk->hk", h, de, optimize=True)
        dh = de @ self.p["out"].T
        self._back(x, "f", kf, dh[:, :, : self.size], grad)
        self._back(x, "b", kb, dh[:, :, self.size :], grad)
        return float((z - score).mean()), {k: v / n for k, v in grad.items()}

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The same as emissions(x)[0], faster: sigmoids by way of tanh, and nothing kept for a way back."""
        s, hs = self.size, []
        half = np.repeat(np.array([0.5, 0.5, 0.5, 1], np.float32), s)
        for d in "fb":
            table_, back = (self.p[f"x{d}"] * half).astype(np.float32), (self.p[f"h{d}"] * half).astype(np.float32)
            h, c = np.zeros((x.shape[1], s), np.float32), np.zeros((x.shape[1], s), np.float32)
            told, z = np.empty((*x.shape, s), np.float32), np.empty((x.shape[1], 4 * s), np.float32)
            for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
                np.matmul(h, back, out=z)
                z += table_[x[t]]
                np.tanh(z, out=z)
                gates = z[:, : 3 * s]
                gates += 1
                gates *= 0.5
                c *= gates[:, s : 2 * s]
                c += gates[:, :s] * z[:, 3 * s :]
                h = np.multiply(gates[:, 2 * s :], np.tanh(c), out=told[t])
            hs.append(told)
        out = self.p["out"].astype(np.float32)
        return hs[0] @ out[:s] + hs[1] @ out[s:] + self.p["bias"].astype(np.float32)


def viterbi(runs: list[np.ndarray], move: np.ndarray) -> list[np.ndarray]:
    """The best tags of each run of scores (time, tags) that has `outside` on either side."""
    order = sorted(range(len(runs)), key=lambda k: -len(runs[k]))
    out: list[np.ndarray] = [np.empty(0, np.int8)] * len(runs)
    for lo in range(0, len(order), 1024):
        part = order[lo : lo + 1024]
        size = np.array([len(runs[k]) for k in part])
        e = np.zeros((size[0], len(part), len(move)))
        for j, k in enumerate(part):
            e[: size[j], j] = runs[k]
        best = e[0] + move[0]
        back = np.zeros(e.shape, np.int8)
        ends = -size
        for t in range(1, size[0]):
            n = int(np.searchsorted(ends, -t))  # runs that are longer than t: the first ones
            step = best[:n, :, None] + move
            back[t, :n] = step.argmax(1)
            best[:n] = step.max(1) + e[t, :n]
        best += move[:, 0]
        tags, lane = np.zeros(e.shape[:2], np.int8), np.arange(len(part))
        now = best.argmax(1)
        for t in range(size[0] - 1, -1, -1):
            n = int(np.searchsorted(ends, -t))
            tags[t, :n] = now[:n]
            now[:n] = back[t, lane[:n], now[:n]]
        for j, k in enumerate(part):
            out[k] = tags[: size[j], j]
    return out


Labelled = list[tuple[str, list[tuple[str, int, int]]]]


def made_examples(n: int, seed: int = 3) -> Labelled:
    """Texts with labelled spans, made by rule: each kind in many written forms, among words and decoys."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    digits = lambda k: "".join(str(x) for x in rng.integers(0, 10, k))
    letters = list("aaaabcdeeeeeffghiiiijklmmnnnooopqrrrsssttttuuvwxyzçéäüñßóè")
    plain = str.maketrans("çéäüñßóè", "ceaunsoe")

    def word():
        w = "".join(pick(letters) for _ in range(int(rng.integers(1, 12))))
        return w.capitalize() if rng.random() < 0.1 else w

    def email():
        name = pick([word(), word() + pick(["." + digits(2), "_" + word(), "-" + word(), "." + word(), digits(2)])]).translate(plain).lower()
        host, end = (pick(["mail", "example", "post", "inbox", word().lower()]) + pick(["", digits(1)])).translate(plain), pick(["com", "example.com", "org", "net", "co.uk"])
        at, dot = pick([("@", "."), ("@", "."), (" @ ", "."), ("@ ", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), (" [at] ", "."), ("(at)", ".")])
        return name + at + host + dot + end.replace(".", dot)

    def ip():
        return pick([".", ".", ".", " . ", "[.]", ". "]).join(str(x) for x in rng.integers(0, 256, 4))

    def card():
        body = pick(["4", "5", "37", "6"]) + digits(13)
        body = (body + digits(2))[:15]
        body += next(c for c in "0123456789" if luhn(body + c))
        sep = pick(["", "", " ", "-", ".", "/", "  "])
        return sep.join(body[k : k + 4] for k in range(0, 16, 4))

    def phone():
        a, b, c = digits(3), digits(3), digits(4)
        return pick([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"+{digits(2)} {a} {b} {c}", f"+1-{a}-{b}-{c}", f"{a}-{b}-{c}", f"+44 {a}.{b}.{c}", f"({a}) {b} {c}"])

    def secret():
        signs = pick(["0123456789abcdef", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"])
        while True:
            found = pick(["", "", "", "sk-", "ghp_"]) + "".join(pick(list(signs)) for _ in range(int(rng.integers(16, 41))))
            found = "AKIA" + found[:16].upper() if rng.random() < 0.2 and "-" not in found and "_" not in found else found
            if plausible("secret", found):
                return found

    def decoy():
        return pick([
            f"token {word()}", f"the password is {word()}", f"key {digits(2)}", f"{word()}={word()}", f"{word()} at {word()}", f"{word()} dot {word()}", f"{word()}{word()}{word()}", f"{word().upper()} {word().upper()}",
            f"Version {digits(1)}.{digits(1)}", f"CC BY-NC {digits(1)}.0", f"{digits(4)}-{digits(2)}-{digits(2)}", f"${digits(3)}.{digits(2)}",
            digits(int(rng.integers(1, 8))), f"{digits(1)}.{digits(1)}.{digits(1)}", f"@{word()}", f"{word()} @ {word()}", f"{digits(2)}:{digits(2)}", f"[{digits(1)}]", f"{digits(3)},{digits(3)},{digits(3)}",
        ])

    makers, out = {"email": email, "ip": ip, "card": card, "phone": phone, "secret": secret}, []
    for _ in range(n):
        text, spans = "", []
        while len(text) < 400:
            text += " ".join(word() for _ in range(int(rng.integers(1, 5) if rng.random() < 0.4 else rng.integers(5, 40)))) + pick([" ", " ", " ", ", ", ": ", "\n", "&&& "])
            kind = pick([*KINDS, "decoy"])
            s = decoy() if kind == "decoy" else makers[kind]()
            if kind == "secret":
                lead, quote = pick(["token = ", "password=", "api_key: ", "secret=", "key=", "Bearer ", "", "", ""]), pick(["", "", '"'])
                text += lead + quote
            else:
                quote = ""
            if kind != "decoy":
                spans.append((kind, len(text), len(text) + len(s)))
            text += s + quote + pick([" ", " ", ".", ", ", "!! ", "\n"])
        out.append((text, spans))
    return out


#: Positions from one window to the next, and how far each reaches beyond them on either side.
STEP, SIDE = 256, 16
WINDOW = STEP + 2 * SIDE
#: Windows that are scored together, and bounds of the CRF's moves, which keep what unsure() asks for low.
TOGETHER, MOVES = 512, 2.0


def fit(examples: Labelled, *, size: int = 16, rounds: int = 200, batch: int = 40, rate: float = 0.025, cut: int = 96, seed: int = 5) -> Tagger:
    """Train a tagger on labelled spans with Adam; deterministic. Texts are cut to windows at random places."""
    rng = np.random.default_rng(seed)
    coded = []
    for text, spans in examples:
        y = np.zeros(len(text), np.int64)
        for kind, a, b in spans:
            y[a:b] = 2 + 2 * KINDS.index(kind)
            y[a] -= 1
        room = (int(rng.integers(0, SIDE)) if rng.random() < 0.2 else 0, max(0, cut - len(text)))  # some windows begin before their text
        coded.append((np.pad(symbols_of(text), room, constant_values=EDGE), np.pad(y, room)))
    tagger = Tagger.new(size, seed)
    m, v = ({k: np.zeros_like(x) for k, x in tagger.p.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        rows = [coded[k] for k in rng.integers(0, len(coded), batch)]
        at = [int(rng.integers(0, len(x) - cut + 1)) for x, _ in rows]
        xs = np.stack([x[c : c + cut] for (x, _), c in zip(rows, at)], 1)
        ys = np.stack([y[c : c + cut] for (_, y), c in zip(rows, at)], 1)
        _, grad = tagger.loss(xs, ys)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        now = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 5 / max(norm, 1e-9))
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            if k == "move":
                tagger.p[k] = np.clip(tagger.p[k], -MOVES, MOVES)
            tagger.p[k] = (tagger.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    tagger.p["move"] = np.clip(tagger.p["move"], -MOVES, MOVES)
    return tagger


@functools.lru_cache(maxsize=1)
def default_tagger() -> Tagger:
    return fit(made_examples(2_500))


def _spans(tags: np.ndarray) -> list[tuple[str, int, int]]:
    """The spans of a tag sequence: a begin tag and the inside tags of its kind that follow."""
    out, k = [], 0
    while k < len(tags):
        if tags[k] % 2 == 1:
            end = k + 1
            while end < len(tags) and tags[end] == tags[k] + 1:
                end += 1
            out.append((KINDS[(int(tags[k]) - 1) // 2], k, end))
            k = end
        else:
            k += 1
    return out


def _merged(tagger: Tagger, coded: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Scores (windows, STEP, tags) of the middle of each window, merged with those of its neighbours in the same text."""
    e = tagger.scores(coded[starts[None, :] + np.arange(WINDOW)[:, None]]).swapaxes(0, 1)
    weight = np.minimum(np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)), 2 * SIDE).astype(np.float32)[:, None]
    total, sums = e[:, SIDE:-SIDE] * weight[SIDE:-SIDE], np.repeat(weight[None, SIDE:-SIDE], len(starts), 0)
    same = (np.diff(starts) == STEP).astype(np.float32)[:, None, None]  # windows of different texts are further apart
    for here, there, mine, other in ((slice(1, None), slice(None, -1), slice(None, SIDE), slice(WINDOW - SIDE, None)), (slice(None, -1), slice(1, None), slice(STEP - SIDE, None), slice(None, SIDE))):
        total[here, mine] += same * e[there, other] * weight[other]
        sums[here, mine] += same * weight[other]
    return total / sums


def unsure(e: np.ndarray, before: np.ndarray, after: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Which positions with scores e (n, tags) may have a tag other than `outside` on a best path.

    before and after tell whether the neighbour is known to be `outside`. Putting `outside` in a
    tag's place changes its score and the moves to and from it; where its lead is more than those
    moves can lose, whatever the neighbours are, it is on every best path.
    """
    into, out_of = move[:, 1:] - move[:, :1], move[1:] - move[:1]
    lost = np.where(before[:, None], into[0], into.max(0)) + np.where(after[:, None], out_of[:, 0], out_of.max(1))
    return ~(e[:, :1] - e[:, 1:] > lost).all(1)


def tagged_spans(texts: list[str], tagger: Tagger, every: bool = False) -> list[list[tuple[str, int, int]]]:
    """The spans on the best path of each whole text, before any check.

    Windows are scored if they or their neighbours hold something that every span that passes
    plausible() has (a digit, an @, or an @ or a dot in words), so the spans that pass are those
    that scoring every window gives; `every` does that, at a multiple of the cost. Scores are kept only where `outside` is not sure: all other positions are on every best path
    as `outside`, so the path parts there into runs that are decoded by themselves.
    """
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    size = np.array([len(t) for t in texts], np.int64)
    blocks = -(-size // STEP)
    base = np.cumsum(blocks * STEP + 2 * SIDE) - (blocks * STEP + 2 * SIDE)
    coded = np.full(int((blocks * STEP + 2 * SIDE).sum()), EDGE, np.uint8)
    for k, t in enumerate(texts):
        coded[base[k] + SIDE : base[k] + SIDE + size[k]] = symbols_of(t)
    own = np.repeat(np.arange(len(texts)), blocks)
    at = (np.arange(len(own)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * STEP  # place in the text of each window's middle
    if not every:
        need = np.zeros(len(own) + 2, bool)
        first = np.cumsum(blocks) - blocks + 1
        for k, t in enumerate(texts):
            hits = np.array([m.start() for m in _NEEDED.finditer(t)], np.int64) // STEP
            need[first[k] + hits] = True
        need[1:-1] |= need[2:] | need[:-2]
        own, at = own[need[1:-1]], at[need[1:-1]]
    start, move = tagger.p["start"].astype(np.float32), tagger.p["move"].astype(np.float32)
    least, kept = float((move[:, 1:] - move[:, :1]).max() + (move[1:] - move[:1]).max()), []
    for lo in range(0, len(own), TOGETHER):
        a, b = max(0, lo - 1), min(len(own), lo + TOGETHER + 1)
        e = _merged(tagger, coded, base[own[a:b]] + at[a:b])[lo - a : lo - a + TOGETHER]
        w, j = np.nonzero(e[:, :, 0] - e[:, :, 1:].max(2) <= least)
        text, place = own[lo + w], at[lo + w] + j
        inside = place < size[text]
        kept.append((text[inside], place[inside], e[w[inside], j[inside]]))
    if not kept:
        return out
    text, place, e = (np.concatenate(x) for x in zip(*kept))
    head, tail = place == 0, place == size[text] - 1
    e[head] += start - move[0]  # as if a position outside stood before each text
    e[tail] -= move[:, 0]
    for _ in range(4):  # what is known of neighbours tells more with each round; a run may also go on unsettled
        next_to = np.concatenate([[False], (np.diff(text) == 0) & (np.diff(place) == 1), [False]])
        may = unsure(e, ~next_to[:-1], ~next_to[1:], move)
        text, place, e = text[may], place[may], e[may]
    cuts = np.flatnonzero((np.diff(text) != 0) | (np.diff(place) != 1)) + 1
    bounds = [*zip([0, *cuts], [*cuts, len(text)])] if len(text) else []
    tags = viterbi([e[a:b] for a, b in bounds], move)
    for (a, _), found in zip(bounds, tags):
        if found.any():
            out[text[a]] += [(k, x + int(place[a]), y + int(place[a])) for k, x, y in _spans(found)]
    return out


#: Characters of texts that are scored together, so that a batch of long texts stays small.
CHARS = 4_000_000


def _portions(texts: list[str]) -> Iterator[list[str]]:
    part, n = [], 0
    for t in texts:
        if part and n + len(t) > CHARS:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t)
    if part:
        yield part


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """For each text its exact matches, and those with the tagger's plausible additions, by kind and start."""
    out = []
    for text, found in zip(texts, (x for part in _portions(texts) for x in tagged_spans(part, tagger))):
        base, added = base_spans(text), []
        for kind, a, b in found:
            while b > a and text[b - 1] in " .,;:!-\"'\n":
                b -= 1
            while b > a and text[a] in " \"'\n=":
                a += 1
            if b > a and plausible(kind, text[a:b]) and not any(a < y and x < b for _, x, y in base + added):
                added.append((kind, a, b))
        out.append((base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def _told(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, tagger: Tagger | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (exact matches), base_sha256, spans and n_spans of each row's whole text.

    `spans` has the exact matches and what the tagger adds, secrets last; n_spans is their number;
    base_sha256 is the digest of the exact ones alone. Null texts are empty; empty texts have no
    spans. Null or repeated ids are passed on, a row for each row; other columns are not read, and an
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    tagger = tagger or default_tagger()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            found = all_spans(b.column("text").to_pylist(), tagger)
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in BASE_KINDS]
            digest = pa.array([hashlib.sha256(_told(base).encode()).hexdigest() for base, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *counts, digest, pa.array([_told(s) for _, s in found], pa.string()), pa.array([len(s) for _, s in found], pa.int64())], names=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string, n_spans long")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
