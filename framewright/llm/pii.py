"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The network is trained in numpy from labelled spans: seeded examples that put addresses, numbers and look-alikes in
many written forms into carrier text (``examples``). It depends on the seed alone, so it is trained once a process.

Every span needs a digit or an at sign, a hard constraint of the decoder's lattice: its states say of an open span
whether it has had one (``_lattice``), and a span can't end before. Text is covered by overlapping windows
(``LENGTH`` characters, every ``STRIDE``); a window without a digit or at sign can only decode to 'outside' and is
not computed, which changes no result. Windows are decoded by Viterbi in large batches. Then each text's spans are
reconciled globally: spans that a window's edge cuts are joined with what the neighbouring window saw, and of
overlapping ones the set of greatest total score stays (weighted interval scheduling over the whole text). Decoded
spans that touch no base span and pass their kind's own test (Luhn, octets, digit counts) are added; base ones stay.

Nulls and edge cases: a null or empty text has no spans; a null doc_id keeps its row; rows are handled one by one, so
repeated ones get equal results; an empty table gives an empty table; columns other than id and text are ignored.
All searches are linear in the text, also where a pattern's plain search would be quadratic.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, text_of, tidied

KINDS = ("email", "ip", "card", "phone")
#: A training example is as long as a window.
LENGTH, STRIDE, HIDDEN, STEPS, BATCH = 64, 32, 12, 800, 48
#: Fixed alphabet: padding, digit, upper case, white space, other, then these by themselves.
OWN = "abcdefghijklmnopqrstuvwxyz@.+-()[]:/_,%\"=#"
SYMBOLS = 5 + len(OWN)
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
#: Decoder states: outside, then for each kind begin and inside without a trigger so far, begin and inside with one.
STATE_TAGS = np.array([0] + [t for k in range(len(KINDS)) for t in (1 + 2 * k, 2 + 2 * k) * 2])
NEVER = np.float32(-1e6)


# ---- base patterns -------------------------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# matches end with whole runs of digits, so no match can begin inside one: the look-behind keeps the search linear
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind that pass the kind's test, by kind, then start."""
    out = []
    if not _TRIGGER.search(text):
        return out
    at, done = text.find("@"), 0
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        m = _DOMAIN.match(text, at + 1) if first < at else None
        if m:
            out.append(("email", first, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


# ---- labelled examples ---------------------------------------------------------------------------------------------


def examples(n: int, seed: int, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(characters as symbols, tags), n x length: carrier text with labelled spans and look-alikes."""
    rng = np.random.default_rng(seed)
    pick = lambda *x: x[rng.integers(len(x))]
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    word = lambda: "".join(pick("th", "an", "er", "ion", "es", "ou", "ver", "é", "ge", "la", "ció", "mo", "ß") for _ in range(rng.integers(1, 5)))

    def card():
        body = num(pick(15, 15, 12, 14, 17))
        body += next(c for c in "0123456789" if luhn(body + c))
        sep = pick("", " ", "-", ".", " ")
        return sep.join(body[i : i + 4] for i in range(0, len(body), 4))

    make = {
        "email": lambda: pick("", "", "<") + word().encode("ascii", "ignore").decode() + pick("", ".", "_") + "x" + pick("", num(2)) + pick("@", "@", "@", " @ ", "[@]") + pick("mail", "post", "corp") + pick("", num(1)) + "." + pick("example", "web") + pick(".com", ".org", ".co.uk", ".de"),
        "ip": lambda: pick(".", ".", ".", "[.]", " . ").join(str(rng.integers(0, 256)) for _ in range(4)),
        "card": card,
        "phone": lambda: pick("+1 ({a}) {b}-{c}", "({a}) {b}-{c}", "+{d} {a} {b} {c}", "{a}-{b}-{c}", "{a}.{b}.{c}", "00{d} {a} {b}{c}", "+{d}{a}{b}{c}", "+{d}-{a}-{b}-{c}").format(a=num(3), b=num(3), c=num(4), d=rng.integers(1, 99)),
        None: lambda: pick(num(rng.integers(1, 9)), hashlib.md5(num(5).encode()).hexdigest(), "v" + ".".join([num(1)] * 3), f"20{num(2)}-0{num(1)}-1{num(1)}", f"{num(2)}:{num(2)}", f"{num(3)}.{num(2)}", "@" + word(), 'token = "' + hashlib.sha1(num(6).encode()).hexdigest() + '"', "#" + num(4), f"{num(1)}. {num(2)}, {num(2)}"),
    }
    xs, ys = np.zeros((n, length), np.int64), np.zeros((n, length), np.int64)
    for row in range(n):
        text, tags = "", []
        junk = pick("", "", "", "%%%", "!!", " |")
        while len(text) < length + 40:
            kind = pick(None, "", "", "", *KINDS) if rng.random() < 0.35 else ""
            if kind == "":
                bit, own = word() + pick("", "", "", ",", ".") + junk, None
                bit = pick(bit, bit, bit, bit.title(), bit.upper())
            else:
                bit, own = make[kind](), kind
            text += bit
            t = 1 + 2 * KINDS.index(own) if own else 0
            tags += [t] + [t + 1 if t else 0] * (len(bit) - 1)
            gap = (junk if own and rng.random() < 0.3 else "") + pick(" ", " ", " ", "\n")
            text, tags = text + gap, tags + [0] * len(gap)
        a = rng.integers(0, 40)
        cut = np.array(tags[a : a + length])
        if cut[0] and not cut[0] % 2:
            cut[0] -= 1  # a cut span begins at the window's edge
        xs[row], ys[row] = symbols(text[a : a + length]), cut
    return xs, ys


def _table() -> np.ndarray:
    table = np.full(256, 4, np.int64)
    for c in range(48, 58):
        table[c] = 1
    for c in range(65, 91):
        table[c] = 2
    table[[9, 10, 11, 12, 13, 32, 0xA0]] = 3
    for k, c in enumerate(OWN):
        table[ord(c)] = 5 + k
    return table


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _table()[np.where(points < 256, points, 0xFF)]


# ---- the network ---------------------------------------------------------------------------------------------------


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(p: dict, x: np.ndarray, keep: bool = False):
    """Emissions (n, t, TAGS) of symbols x (n, t); both directions advance together."""
    n, t = x.shape
    both = np.stack([x, x[:, ::-1]])
    h = np.zeros((2, n, HIDDEN), p["wh"].dtype)
    c, outs, kept = h.copy(), np.zeros((2, t, n, HIDDEN), p["wh"].dtype), []
    side = np.arange(2)[:, None]
    for k in range(t):
        z = p["wx"][side, both[:, :, k]] + h @ p["wh"]
        gates = _sigmoid(z[..., : 3 * HIDDEN])
        i, f, o = np.split(gates, 3, axis=-1)
        g = np.tanh(z[..., 3 * HIDDEN :])
        before = (h, c)
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        outs[:, k] = h
        if keep:
            kept.append((*before, i, f, o, g, tc))
    hidden = np.concatenate([outs[0], outs[1, ::-1]], axis=-1).transpose(1, 0, 2)
    return hidden @ p["wo"] + p["bo"], (both, hidden, kept)


def _allowed() -> np.ndarray:
    """Transitions: inside follows begin or inside of its kind only."""
    ok = np.zeros((TAGS, TAGS))
    for b in range(2, TAGS, 2):
        ok[:, b] = -1e4
        ok[[b - 1, b], b] = 0
    return ok


def _lse(x, axis):
    m = x.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis))


def _crf(e: np.ndarray, trans: np.ndarray, y: np.ndarray):
    """Gradients of the mean negative log-likelihood by emissions and transitions, by forward and backward sums."""
    n, t, k = e.shape
    fwd, bwd = np.zeros((t, n, k)), np.zeros((t, n, k))
    fwd[0] = e[:, 0]
    for s in range(1, t):
        fwd[s] = _lse(fwd[s - 1][:, :, None] + trans, 1) + e[:, s]
    for s in range(t - 2, -1, -1):
        bwd[s] = _lse(trans + (e[:, s + 1] + bwd[s + 1])[:, None, :], 2)
    z = _lse(fwd[-1], 1)
    ge = np.exp(fwd + bwd - z[None, :, None]).transpose(1, 0, 2)
    pair = fwd[:-1].transpose(1, 0, 2)[:, :, :, None] + trans + (e.transpose(1, 0, 2)[1:] + bwd[1:]).transpose(1, 0, 2)[:, :, None, :]
    gt = np.exp(pair - z[:, None, None, None]).sum((0, 1))
    rows, cols = np.arange(n)[:, None], np.arange(t)
    ge[rows, cols, y] -= 1
    np.subtract.at(gt, (y[:, :-1], y[:, 1:]), 1)
    return ge / n, gt / n


def _backward(p, cache, de):
    both, hidden, kept = cache
    g = {"wo": np.einsum("nth,ntk->hk", hidden, de), "bo": de.sum((0, 1)), "wx": np.zeros_like(p["wx"]), "wh": np.zeros_like(p["wh"])}
    dh_all = (de @ p["wo"].T).transpose(1, 0, 2)
    dh_all = np.stack([dh_all[..., :HIDDEN], dh_all[::-1, :, HIDDEN:]])
    dh, dc = np.zeros_like(kept[0][0]), np.zeros_like(kept[0][0])
    side = np.arange(2)[:, None]
    for k in range(len(kept) - 1, -1, -1):
        h0, c0, i, f, o, gg, tc = kept[k]
        dh = dh + dh_all[:, k]
        dc = dc + dh * o * (1 - tc**2)
        dz = np.concatenate([dc * gg * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - gg**2)], axis=-1)
        g["wh"] += h0.transpose(0, 2, 1) @ dz
        np.add.at(g["wx"], (side, both[:, :, k]), dz)
        dh, dc = dz @ p["wh"].transpose(0, 2, 1), dc * f
    return g


@lru_cache(maxsize=2)
def trained(seed: int = 11, steps: int = STEPS) -> dict:
    """The model, by Adam on ``examples``. The same seed gives the same model."""
    rng = np.random.default_rng(seed)
    p = {
        "wx": rng.normal(0, 0.3, (2, SYMBOLS, 4 * HIDDEN)),
        "wh": rng.normal(0, 0.3, (2, HIDDEN, 4 * HIDDEN)),
        "wo": rng.normal(0, 0.3, (2 * HIDDEN, TAGS)),
        "bo": np.zeros(TAGS),
        "trans": np.zeros((TAGS, TAGS)),
    }
    p["wx"][:, :, HIDDEN : 2 * HIDDEN] += 1.0  # remember at first
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    xs, ys = examples(2400, seed)
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(xs), BATCH)
        e, cache = _run(p, xs[rows], True)
        de, dt = _crf(e, p["trans"] + _allowed(), ys[rows])
        g = _backward(p, cache, de / LENGTH * 8) | {"trans": dt / LENGTH * 8}
        rate = 0.02 * min(1, 2 * (1 - step / (steps + 1)))
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    p["trans"] = p["trans"] + _allowed()
    return {k: x.astype(np.float32) for k, x in p.items()}


def _lattice(trans: np.ndarray) -> np.ndarray:
    """(2, states, states): scores of steps onto a character that is no trigger (0) or one (1), ``NEVER`` where not allowed.

    An open span without a trigger goes on inside its kind only; it may end once it has had one.
    """
    out = np.full((2, len(STATE_TAGS), len(STATE_TAGS)), NEVER, np.float32)
    first = range(1, len(STATE_TAGS), 4)
    closed = [0] + [k + x for k in first for x in (2, 3)]
    for trigger in (0, 1):
        for a in closed:
            out[trigger, a, 0] = trans[0 if a == 0 else STATE_TAGS[a], 0]
            for k in first:
                b = k + 2 * trigger
                out[trigger, a, b] = trans[STATE_TAGS[a], STATE_TAGS[b]]
        for k in first:
            for a in (k, k + 1):  # none so far
                b = k + 1 + 2 * trigger
                out[trigger, a, b] = trans[STATE_TAGS[a], STATE_TAGS[b]]
            for a in (k + 2, k + 3):
                out[trigger, a, k + 3] = trans[STATE_TAGS[a], STATE_TAGS[k + 3]]
    return out


TRIGGERS = (1, 5 + OWN.index("@"))


def viterbi(e: np.ndarray, trans: np.ndarray, trigger: np.ndarray) -> np.ndarray:
    """Best tags (n, t) for emissions (n, t, TAGS), under the lattice."""
    n, t, _ = e.shape
    steps = _lattice(trans)
    own = e[:, :, STATE_TAGS]
    first = np.arange(1, len(STATE_TAGS), 4)
    score = np.full((n, len(STATE_TAGS)), NEVER, np.float32)
    score[:, 0] = own[:, 0, 0]
    for k in first:
        score[:, k] = np.where(trigger[:, 0], NEVER, own[:, 0, k])
        score[:, k + 2] = np.where(trigger[:, 0], own[:, 0, k + 2], NEVER)
    back = np.zeros((t, n, len(STATE_TAGS)), np.int8)
    for s in range(1, t):
        every = score[:, :, None] + steps[trigger[:, s].astype(int)]
        back[s] = every.argmax(1)
        score = np.take_along_axis(every, back[s][:, None, :].astype(int), 1)[:, 0] + own[:, s]
    for k in first:
        score[:, [k, k + 1]] = NEVER  # no span ends without a trigger
    state = np.zeros((n, t), np.int64)
    state[:, -1] = score.argmax(1)
    rows = np.arange(n)
    for s in range(t - 1, 0, -1):
        state[:, s - 1] = back[s, rows, state[:, s]]
    return STATE_TAGS[state]


def decode(p: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags of windows (n, t) by Viterbi, and each character's lead over 'outside'. Padding is outside."""
    e, _ = _run(p, x)
    e[x == 0] = np.r_[0, np.full(TAGS - 1, -1e4)].astype(np.float32)
    tags = viterbi(e, p["trans"], np.isin(x, TRIGGERS))
    return tags, np.take_along_axis(e, tags[:, :, None], 2)[:, :, 0] - e[:, :, 0]


def windows_of(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an at sign."""
    last = max(0, -(-(len(text) - LENGTH) // STRIDE))
    found, past = [], -1
    for m in _TRIGGER.finditer(text):
        k = m.start() // STRIDE
        if k > past:
            found += [j for j in (k - 1, k) if 0 <= j <= last and (not found or j > found[-1])]
            past = k
    if not found and past >= 0:
        found = [last]
    return [j * STRIDE for j in found]


def reconcile(spans: list[tuple[str, int, int, float, bool]]) -> list[tuple[str, int, int]]:
    """One text's decoded spans (kind, start, end, score, cut by a window) -> the non-overlapping set of greatest score."""
    joined: dict[tuple, float] = {}
    for kind in KINDS:
        own = sorted(x[1:] for x in spans if x[0] == kind)
        run = None
        for start, end, score, cut in own:
            if run and start < run[1] and (cut or run[3]):
                run = (run[0], max(end, run[1]), max(score, run[2]), run[3] if end <= run[1] else cut)
            else:
                if run:
                    joined[kind, *run[:2]] = max(run[2], joined.get((kind, *run[:2]), 0))
                run = (start, end, score, cut)
        if run:
            joined[kind, *run[:2]] = max(run[2], joined.get((kind, *run[:2]), 0))
    from bisect import bisect_right

    own = sorted(joined.items(), key=lambda x: (x[0][2], x[0]))
    ends = [x[0][2] for x in own]
    best: list[tuple[float, tuple]] = [(0.0, ())]  # (score, link to what stays)
    for k, ((kind, start, end), score) in enumerate(own):
        before = best[bisect_right(ends, start, hi=k)]
        best.append(max(best[-1], (before[0] + max(score, 0.0), ((kind, start, end), before[1])), key=lambda x: x[0]))
    out, link = [], best[-1][1]
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


_DATE = re.compile(r"(19|20)?\d\d[-./ ]\d{1,2}[-./ ]\d{1,4}")


def plausible(kind: str, s: str) -> bool:
    """A decoded span's own test, which keeps clean text clean."""
    digits = _digits(s)
    if kind == "email":
        return bool(re.fullmatch(r"[^\s@]*[A-Za-z0-9][^\s@]*[\s\[(]{0,2}@[\s\])]{0,2}[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", s))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(( ?\. ?|\[\.\])[0-9]{1,3}){3}", s)) and all(map(_octet, re.findall("[0-9]+", s)))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9][0-9 .-]*[0-9]", s)) and len(set(digits)) > 2
    return 9 <= len(digits) <= 15 and bool(re.fullmatch(r"(\+|00|\()?[0-9][0-9 ().-]*[0-9]", s)) and bool(re.search(r"[ ().+-]", s)) and not _DATE.fullmatch(s) and (s[0] in "0(" or not re.search(r"[0-9]{8,}", s[1:]))


def spans_of(texts: list[str], p: dict, chunk: int = 1024) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(x) for x in texts]
    todo = [(k, a) for k, x in enumerate(texts) for a in windows_of(x)]
    seen: list[list] = [[] for _ in texts]
    for at in range(0, len(todo), chunk):
        part = todo[at : at + chunk]
        x = np.zeros((len(part), LENGTH), np.int64)
        for row, (k, a) in enumerate(part):
            got = symbols(texts[k][a : a + LENGTH])
            x[row, : len(got)] = got
        tags, lead = decode(p, x)
        for row in np.flatnonzero(tags.any(1)):
            k, a = part[row]
            t = tags[row]
            for s in np.flatnonzero((t > 0) & (t % 2 == 1)):
                e = s + 1
                while e < LENGTH and t[e] == t[s] + 1:
                    e += 1
                cut = (s == 0 and a > 0) or (e == LENGTH and a + LENGTH < len(texts[k]))
                seen[k].append((KINDS[(t[s] - 1) // 2], a + int(s), a + int(e), float(lead[row, s:e].sum()), bool(cut)))
    out = []
    for text, own, found in zip(texts, base, seen):
        added = []
        if found:
            for kind, s, e in reconcile(found):
                while s < e and text[s] in " \n\t":
                    s += 1
                while e > s and text[e - 1] in " \n\t.,;":
                    e -= 1
                # a span covers whole runs: a decoded edge may be a character or two off
                while s > 0 and (text[s - 1].isalnum() or text[s - 1] in "+(") and s < e:
                    s -= 1
                while e < len(text) and text[e].isalnum():
                    e += 1
                if not any(s < z and a < e for _, a, z in own) and plausible(kind, text[s:e]):
                    added.append((kind, s, e))
        out.append((own, added))
    return out


# ---- on tables -----------------------------------------------------------------------------------------------------


def _line(spans) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest and all spans of every text; spans in code points, end exclusive."""
    model = trained()

    def compute(batches):
        for batch in batches:
            got = spans_of(batch.column(1).to_pylist(), model)
            counts = [pa.array([sum(s[0] == k for s in b) for b, _ in got], pa.int64()) for k in KINDS]
            digest = [hashlib.sha256(_line(b).encode()).hexdigest() for b, _ in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digest, pa.string()), pa.array([_line(b + a) for b, a in got], pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(tidied(compute), SCHEMA)


def redacted(text: str, spans) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the one that begins first counts."""
    out, done = [], 0
    for kind, a, z in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
            done = z
        elif z > done:
            done = z
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in the text, and n_chars, where there is one, counted anew."""
    model = trained()

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for at in range(0, len(texts), 256):  # few texts at a time become Python's
                part = texts[at : at + 256].to_pylist()
                own = [x or "" for x in part]
                got = [redacted(t, b + a) for t, (b, a) in zip(own, spans_of(own, model))]
                out.append(pa.array([None if x is None else g for x, g in zip(part, got)], pa.string()))
            yield pa.concat_arrays(out) if out else pa.array([], pa.string())
        give_back()

    out = docs.withColumn(text_col, clean(F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(F.length(text_col).cast("long")))
    return out.select(*docs.columns)


def op1_pii(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
