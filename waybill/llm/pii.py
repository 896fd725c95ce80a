"""Personal data: fixed patterns, and a character BiLSTM-CRF for forms they miss."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
WINDOW, STRIDE, MARGIN = 96, 48, 48
# Long regions are decoded in pieces of PIECE characters that share OVERLAP at each end, and so
# many characters are scored at once.
PIECE, OVERLAP, AT_ONCE = 2048, 256, 200_000
MIN_CONFIDENCE = 0.8

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[](?:at|AT|dot|DOT)[)\]]")
_MAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+ ?(?:@|[(\[]at[)\]]) ?[A-Za-z0-9-]+"
    r"(?: ?(?:\.(?=[A-Za-z0-9-])|[(\[]dot[)\]]) ?[A-Za-z0-9-]+)+"
)
_LABELS = re.compile(r"(?: ?\. ?[A-Za-z0-9-]+)*")
_DIGIT = re.compile("[0-9]")

Span = tuple[str, int, int]


def luhn(digits: Sequence[int]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind: str, text: str) -> bool:
    digits = [int(d) for d in _DIGIT.findall(text)]
    if kind == "ip":
        # Long parts are too large; int() of very long ones would be slow.
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that don't overlap, without those that fail its rule.

    Emails are found from their @, and IPs only where digits begin, so that the time is
    linear also in very long runs of letters or digits.
    """
    found: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            found.append(("email", start, last))
        at = text.find("@", max(at + 1, last))
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        if kind == "phone" and "+" not in text:
            continue
        found += [
            (kind, *m.span()) for m in pattern.finditer(text) if valid(kind, m.group())
        ]
    return found


# --- the model ---

def _char_codes() -> np.ndarray:
    """Input symbol of each code point below 128: letters by letter, digits as one, marks
    one by one, blanks as one. 0 is beyond the text, 1 any other code point."""
    codes = np.ones(128, np.int64)
    codes[list(b" \t\n\r\x0b\x0c")] = 2
    codes[48:58] = 3
    for i in range(26):
        codes[65 + i] = codes[97 + i] = 4 + i
    for i, mark in enumerate("@.-_+%()[]:/,=\"'#"):
        codes[ord(mark)] = 30 + i
    return codes


_CODES = _char_codes()
SYMBOLS = 48


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(points < 128, _CODES[np.minimum(points, 127)], 1)


def labelled_examples(count: int, seed: int) -> list[tuple[str, list[Span]]]:
    """Made-up texts with labelled spans: usual and unusual ways to write personal data,
    among words of random letters and other things with digits in them."""
    rng = np.random.default_rng(seed)

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def letters(low: int, high: int) -> str:
        alphabet = pick(["etaoinshrdluenrtidsa", "aeionrstlcdupmévàçêñüß"])
        return "".join(pick(alphabet) for _ in range(int(rng.integers(low, high + 1))))

    def digits(n: int) -> str:
        return "".join(str(int(d)) for d in rng.integers(0, 10, n))

    def number(high: int) -> str:
        return str(int(rng.integers(0, high)))

    def card() -> str:
        first = [int(d) for d in rng.integers(0, 10, 15)]
        last = next(d for d in range(10) if luhn([*first, d]))
        whole = "".join(map(str, [*first, last]))
        mark = pick(["", "", " ", "-", ".", "/"])
        return mark.join(whole[i: i + 4] for i in range(0, 16, 4))

    def email() -> str:
        plain = "abcdefghijklmnopqrstuvwxyz"
        name = "".join(pick(plain) for _ in range(int(rng.integers(2, pick([8, 8, 28])))))
        name += pick(["", ".", "_"]) + pick([digits(2), "".join(pick(plain) for _ in range(3))])
        host = "".join(pick(plain) for _ in range(int(rng.integers(3, pick([8, 8, 20]))))) + pick(["", digits(1)])
        at, dot = pick([("@", "."), ("@", "."), (" (at) ", "."), (" [at] ", "."), (" (at) ", " (dot) "),
                        (" (at) ", " (dot) "), (" [at] ", " [dot] ")])
        return name + at + host + dot + pick(["example.", ""]).replace(".", dot) + pick(["com", "org", "net", "de"])

    def phone() -> str:
        return pick([
            lambda: f"+{number(99)} ({digits(3)}) {digits(3)}-{digits(4)}",
            lambda: f"({digits(3)}) {digits(3)}-{digits(4)}",
            lambda: f"{digits(3)}-{digits(3)}-{digits(4)}",
            lambda: f"+{number(99)} {digits(3)} {digits(7)}",
            lambda: f"00{number(99)} {digits(2)} {digits(7)}",
        ])()

    def other() -> str:
        return pick([
            lambda: 'token = "' + "".join(pick("0123456789abcdef") for _ in range(24)) + '"',
            lambda: f"version {number(9)}.{number(9)}", lambda: f"CC BY-NC {number(5)}.0",
            lambda: digits(int(rng.integers(1, 7))), lambda: f"{number(300)}%",
            lambda: f"({number(99)})", lambda: f"{number(28)}.{number(12)}.{2000 + int(number(30))}",
            lambda: f"{number(9)}.{number(20)}.{number(20)}", lambda: f"@{letters(3, 8)}",
            lambda: f"{digits(4)}-{number(12)}-{number(28)}",
        ])()

    makers = {
        "email": email, "card": card, "phone": phone,
        "ip": lambda: ".".join(number(256) for _ in range(4)),
    }
    examples = []
    for _ in range(count):
        text, spans = "".join(letters(2, 8) + " " for _ in range(int(rng.integers(0, 4)))), []
        for _ in range(pick([1, 1, 2, 3])):
            kind = pick([*KINDS, None, None])
            made = makers[kind]() if kind else other()
            if kind:
                spans.append((kind, len(text), len(text) + len(made)))
            text += made + pick([" ", ". ", ", ", "\n", " or "])
        text += " ".join(letters(2, 8) for _ in range(int(rng.integers(0, 4))))
        examples.append((text, spans))
    return examples


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """Character-level bidirectional LSTM with a linear-chain CRF on top, in numpy.
    Everything is one dict of arrays, so it is small and easy to send to tasks."""

    def __init__(self, embed: int = 8, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)

        def init(*shape: int) -> np.ndarray:
            return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

        self.hidden = hidden
        self.w = {"embed": init(SYMBOLS, embed) * 2, "out": init(2 * hidden, TAGS),
                  "out_bias": np.zeros(TAGS, np.float32),
                  "moves": np.zeros((TAGS, TAGS), np.float32)}
        for side in "fb":
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden: 2 * hidden] = 1  # remember at first
            self.w |= {f"x{side}": init(embed, 4 * hidden), f"h{side}": init(hidden, 4 * hidden),
                       f"b{side}": bias}

    def _run(self, x: np.ndarray, side: str, keep: bool):
        """States of one direction over x (time, batch, embed), in reading order of ``side``."""
        size, steps = self.hidden, range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
        h = c = np.zeros((x.shape[1], size), np.float32)
        states, trail = np.empty((*x.shape[:2], size), np.float32), []
        inputs = x @ self.w[f"x{side}"] + self.w[f"b{side}"]
        for t in steps:
            gates = inputs[t] + h @ self.w[f"h{side}"]
            rest = _sigmoid(gates[:, : 3 * size])
            i, f, o = rest[:, :size], rest[:, size: 2 * size], rest[:, 2 * size:]
            g = np.tanh(gates[:, 3 * size:])
            old_h, old_c = h, c
            c = f * c + i * g
            tanh_c = np.tanh(c)
            h = o * tanh_c
            states[t] = h
            if keep:
                trail.append((t, i, f, o, g, old_h, old_c, tanh_c))
        return states, trail

    def scores(self, codes: np.ndarray, keep: bool = False):
        """Scores (time, batch, tag) of symbol windows (batch, time)."""
        x = self.w["embed"][codes.T]
        forward, one = self._run(x, "f", keep)
        backward, two = self._run(x, "b", keep)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.w["out"] + self.w["out_bias"], (x, both, one, two)

    def _sweeps(self, scores: np.ndarray):
        """Log sums of all ways to and from each tag, and of all ways."""
        moves, steps = self.w["moves"], len(scores)
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, steps):
            ahead[t] = scores[t] + _log_sum(ahead[t - 1][:, :, None] + moves, 1)
        for t in range(steps - 2, -1, -1):
            behind[t] = _log_sum(moves + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        return ahead, behind, _log_sum(ahead[-1], 1)

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each tag (time, batch, tag) given the whole sequence."""
        ahead, behind, total = self._sweeps(scores)
        return np.exp(ahead + behind - total[None, :, None])

    def marginals(self, scores: np.ndarray):
        """CRF forward-backward: tag probabilities, and the sums of move probabilities."""
        ahead, behind, total = self._sweeps(scores)
        tags = np.exp(ahead + behind - total[None, :, None])
        joint = np.exp(
            ahead[:-1, :, :, None] + self.w["moves"] + (scores[1:] + behind[1:])[:, :, None, :]
            - total[None, :, None, None]
        )
        return tags, joint.sum(axis=(0, 1))

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log likelihood of ``tags`` (batch, time)."""
        scores, (x, both, one, two) = self.scores(codes, keep=True)
        batch, gold = codes.shape[0], tags.T
        chance, joint = self.marginals(scores)
        d_scores = chance
        np.put_along_axis(
            d_scores, gold[:, :, None],
            np.take_along_axis(d_scores, gold[:, :, None], 2) - 1, 2,
        )
        np.add.at(joint, (gold[:-1], gold[1:]), -1)
        d_scores = d_scores / batch
        grads = {"moves": joint / batch, "out_bias": d_scores.sum((0, 1)),
                 "out": np.einsum("tbh,tbk->hk", both, d_scores)}
        d_both, size = d_scores @ self.w["out"].T, self.hidden
        d_x = np.zeros_like(x)
        for side, trail, d_states in (("f", one, d_both[..., :size]), ("b", two, d_both[..., size:])):
            d_h = d_c = np.zeros((batch, size), np.float32)
            d_gates = np.empty((*x.shape[:2], 4 * size), np.float32)
            grad_h = np.zeros_like(self.w[f"h{side}"])
            for t, i, f, o, g, old_h, old_c, tanh_c in reversed(trail):
                d_h = d_h + d_states[t]
                d_c = d_c + d_h * o * (1 - tanh_c**2)
                d_gates[t] = np.concatenate(
                    [d_c * g * i * (1 - i), d_c * old_c * f * (1 - f),
                     d_h * tanh_c * o * (1 - o), d_c * i * (1 - g**2)], axis=1,
                )
                grad_h += old_h.T @ d_gates[t]
                d_h, d_c = d_gates[t] @ self.w[f"h{side}"].T, d_c * f
            grads |= {f"h{side}": grad_h, f"b{side}": d_gates.sum((0, 1)),
                      f"x{side}": np.einsum("tbe,tbg->eg", x, d_gates)}
            d_x += d_gates @ self.w[f"x{side}"].T
        grads["embed"] = np.zeros_like(self.w["embed"])
        np.add.at(grads["embed"], codes.T, d_x)
        return grads

    def fit(self, codes: np.ndarray, tags: np.ndarray, steps: int, batch: int, seed: int) -> "Tagger":
        """Adam over random batches."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(codes), batch)
            rate = 0.02 * (1 - step / (steps + 1)) + 0.001
            for k, g in self.gradients(codes[rows], tags[rows]).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                fixed = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
                self.w[k] = (self.w[k] - rate * fixed[0] / (np.sqrt(fixed[1]) + 1e-8)).astype(np.float32)
        return self

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best tags of one sequence of scores (time, tag)."""
        moves, best, back = self.w["moves"], scores[0], []
        for t in range(1, len(scores)):
            ways = best[:, None] + moves
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + scores[t]
        path = [int(best.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return np.array(path[::-1])


def training_windows(examples: Sequence[tuple[str, list[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of windows over labelled texts, as cut in ``regions``."""
    codes, tags = [], []
    for text, spans in examples:
        own = np.zeros(len(text), np.int64)
        for kind, start, end in spans:
            begin = 1 + 2 * KINDS.index(kind)
            own[start], own[start + 1: end] = begin, begin + 1
        symbols = encode(text)
        for start in range(0, max(1, len(text) - WINDOW + STRIDE), STRIDE):
            piece = slice(start, start + WINDOW)
            pad = (0, WINDOW - len(symbols[piece]))
            codes.append(np.pad(symbols[piece], pad))
            tags.append(np.pad(own[piece], pad))
    return np.array(codes), np.array(tags)


@cache
def trained(examples: int = 3000, steps: int = 300, batch: int = 48, seed: int = 11) -> Tagger:
    """The default model; it depends on these numbers alone."""
    codes, tags = training_windows(labelled_examples(examples, seed))
    return Tagger(seed=seed).fit(codes, tags, steps, batch, seed)


def regions(text: str) -> list[tuple[int, int]]:
    """Parts of a text around everything with a digit or a sign or word for "at" or "dot".

    A part ends between words, not within one, and takes in the labels that dots add to it. So
    every span that ``plausible`` accepts lies whole in a part: it has a digit or an "at", and
    nothing of it is further from such a place than one word, a dotted label or a "dot".
    """
    found: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        if found and m.end() + MARGIN <= found[-1][1]:
            continue
        start, end = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        least = found[-1][1] if found else 0
        while start > least and not text[start - 1].isspace():
            start -= 1
        end = max(end, least)
        while end < len(text) and not text[end].isspace():
            end += 1
        end = _LABELS.match(text, end).end()
        if found and start <= least:
            found[-1] = found[-1][0], end
        else:
            found.append((start, end))
    return found


def everywhere(text: str) -> list[tuple[int, int]]:
    """The whole text as one region."""
    return [(0, len(text))] if text else []


def pieces(start: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """Overlapping pieces of a region, each with the part of which it tells the spans: those that
    begin there. Neighbours share OVERLAP characters on either side of a border, so
    any span up to that length is whole in the piece that tells it."""
    core = PIECE - 2 * OVERLAP
    if end - start <= PIECE:
        yield start, end, start, end
        return
    for low in range(start, end, core):
        high = min(end, low + core)
        yield max(start, low - OVERLAP), min(end, high + OVERLAP), low, high


def _piece_spans(model: Tagger, mean: np.ndarray) -> Iterator[Span]:
    """Spans on the best path through a piece's scores (time, tag). One without a begin
    starts where its kind does."""
    tags = model.decode(mean)
    if not tags.any():
        return
    sure = model.chances(mean[:, None, :])[np.arange(len(tags)), 0, tags]
    at = 0
    while at < len(tags):
        kind = (tags[at] - 1) // 2
        stop = at + 1
        if tags[at]:
            while stop < len(tags) and tags[stop] == 2 * kind + 2:
                stop += 1
            if sure[at:stop].mean() >= MIN_CONFIDENCE:
                yield KINDS[kind], at, stop
        at = stop


def _mean_scores(model: Tagger, parts: Sequence[str]) -> Iterator[np.ndarray]:
    """Scores (time, tag) of each part: the mean over its windows, weighted to their middles."""
    cut, firsts = [], [0]
    for part in parts:
        symbols = encode(part)
        for at in range(0, max(1, len(symbols) - WINDOW + STRIDE), STRIDE):
            window = symbols[at: at + WINDOW]
            cut.append(np.pad(window, (0, WINDOW - len(window))))
        firsts.append(len(cut))
    scores = np.concatenate(
        [model.scores(np.array(cut[k: k + 512]))[0] for k in range(0, len(cut), 512)], axis=1
    )
    weight = (np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1.0)[:, None]
    for part, first, last in zip(parts, firsts, firsts[1:]):
        total, weights = np.zeros((len(part), TAGS)), np.zeros((len(part), 1))
        for k in range(first, last):
            at = (k - first) * STRIDE
            n = min(WINDOW, len(part) - at)
            total[at: at + n] += (scores[:, k] * weight)[:n]
            weights[at: at + n] += weight[:n]
        yield total / weights


def tagged_spans(model: Tagger, texts: Sequence[str], cut=regions) -> list[list[Span]]:
    """Spans that the model marks in each text.

    Regions (``cut``) are read in overlapping windows and scored in batches. A region's scores are
    the mean over its windows, and one decoding of the region, or of its pieces if it is
    long, reconciles them. A span counts if its tags have a
    probability of at least MIN_CONFIDENCE on the mean. Memory doesn't grow with the texts.
    """
    spans: list[list[Span]] = [[] for _ in texts]
    waiting: list[tuple[int, int, int, int, int]] = []

    def tell() -> None:
        means = _mean_scores(model, [texts[i][start:end] for i, start, end, _, _ in waiting])
        for (i, start, _, low, high), mean in zip(waiting, means):
            for kind, begin, stop in _piece_spans(model, mean):
                if low <= start + begin < high:
                    spans[i].append((kind, start + begin, start + stop))
        waiting.clear()

    size = 0
    for i, text in enumerate(texts):
        for region in cut(text):
            for piece in pieces(*region):
                waiting.append((i, *piece))
                size += piece[1] - piece[0]
                if size >= AT_ONCE:
                    tell()
                    size = 0
    if waiting:
        tell()
    return spans


def fitted(kind: str, text: str, start: int, end: int) -> Span:
    """A marked span at the borders of what it names: one that has part of a mail address, or a
    word too many, is put to the address that it overlaps, within OVERLAP characters of it."""
    if kind != "email":
        return kind, start, end
    low, high = max(0, start - OVERLAP), min(len(text), end + OVERLAP)
    while low and not text[low - 1].isspace():
        low -= 1
    while high < len(text) and not text[high].isspace():
        high += 1
    for m in _MAIL.finditer(text, low, high):
        if m.start() < end and start < m.end():
            return kind, *m.span()
    return kind, start, end


def plausible(kind: str, text: str) -> bool:
    """Rules that a marked span must meet besides."""
    if kind == "email":
        return bool(_MAIL.fullmatch(text))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", text)) and valid(kind, text)
    return bool(re.fullmatch(r"[+(]?[0-9][0-9 ()./-]*[0-9]", text)) and valid(kind, text)


def joined(spans: Sequence[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


def _find(model: Tagger):
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column(1).to_pylist()]
                counts = {kind: [0] * len(texts) for kind in KINDS}
                digests, everything = [nothing] * len(texts), [""] * len(texts)
                hit = [i for i, t in enumerate(texts) if _TRIGGER.search(t)]
                marked = tagged_spans(model, [texts[i] for i in hit])
                for i, more in zip(hit, marked):
                    base = base_spans(texts[i])
                    for kind, _, _ in base:
                        counts[kind][i] += 1
                    digests[i] = hashlib.sha256(joined(base).encode()).hexdigest()
                    ends = sorted((s, e) for _, s, e in base)
                    near = {fitted(k, texts[i], s, e) for k, s, e in more}
                    free = [
                        (k, s, e) for k, s, e in near
                        if plausible(k, texts[i][s:e]) and not any(a < e and s < b for a, b in ends)
                    ]
                    everything[i] = joined([*base, *free])
                yield pa.record_batch(
                    [part.column(0), *[pa.array(counts[k], pa.int64()) for k in KINDS],
                     pa.array(digests), pa.array(everything)],
                    names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
                )

    return run


def personal_data(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """Find personal data in every whole text of ``docs`` (doc_id, text).

    Base spans come from fixed patterns per kind and always stay; n_* counts them. The
    model adds spans of the same kinds that no base span overlaps. Places count code
    points, the end exclusive. A null text is empty. Rows are judged one by one, so equal rows get
    equal results; an empty table gives an empty result.

    Columns: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.
    """
    columns = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    return docs.select(*columns).mapInArrow(
        _find(model or trained()),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )
