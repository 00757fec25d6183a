"""Personal data by a semi-Markov conditional random field.

Fixed patterns give the base spans, found in linear time.  Around every digit
run, "@" or spelt-out "at" near a dot that no base span covers, a semi-Markov CRF scores
whole candidate segments (up to ``MAX_TOKENS`` tokens, as many as 19 digits
written one by one) by features of the whole span: digits and their grouping,
separators, checksums, octet ranges, neighbours.  Dynamic programming over the
tokens then chooses boundaries and types jointly; tokens of no entity score
nothing, so only segments that hold an anchor need scoring.  A window reaches
as far as any segment around its anchors: over the tokens without letters
around a digit run, ``MAX_TOKENS`` either way of an "at".

The weights are trained here, by exact segmental likelihood, on windows of a
bounded sample of documents (``TRAIN_DOCS`` by md5 of the id).  The base spans
are labels as they stand; values of every kind, generated from digits and from
words of the window, are set in beside them in each form by which people dodge
patterns (spelt-out or bracketed marks, other separators, no plus), all forms in
turn and so equally often; near misses (broken checksums, octets above 255,
short numbers, an "at" in prose) are left unlabelled.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.batches import bounded_batches
from ladle.llm.registry import query, table

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 400
TRAIN_WINDOWS = 300
EPOCHS = 12
MAX_TOKENS = 40
CONTEXT = 60          # characters of text on either side of a training span
MARGIN = 1.5          # log-odds a segment must have over no entity
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
_MARK = re.compile(r"[0-9]+|@")
_AT = re.compile(r"(?<![A-Za-z])[Aa][Tt](?![A-Za-z])")
_DOT = re.compile(r"\.|(?<![A-Za-z])[Dd][Oo][Tt](?![A-Za-z])")
_HINT = r"@|[0-9]{2}"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern's leftmost matches, led by the "@" so that no run is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    for m in _CARD.finditer(text):
        n = _digits(m.group())
        if 14 <= len(n) <= 19 and luhn(n):
            out.append((m.start(), 2, m.end()))
    if text.count(".") > 2:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.group().split("."))]
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out)


def _reaches(text: str, start: int, place: int) -> bool:
    """Whether a segment from the token at ``start`` can hold the one at ``place``."""
    for m in islice(_TOKEN.finditer(text, start), MAX_TOKENS):
        if m.start() >= place:
            return m.start() == place
    return False


def anchors(text: str) -> list[tuple[int, int]]:
    """(start, end) of digit runs, "@" and spelt-out "at", in order.

    An "at" counts where one segment can hold it and a "." or a "dot": no
    other segment without a digit or "@" can be of any type (``possible``)."""
    out = [m.span() for m in _MARK.finditer(text)]
    words = [m.span() for m in _AT.finditer(text)]
    if not words:
        return out
    dots = _DOT.finditer(text)
    before, after = -1, next(dots, None)
    for start, end in words:
        while after and after.start() < start:
            before, after = after.start(), next(dots, None)
        if before >= 0 and _reaches(text, before, start) or after and _reaches(text, start, after.start()):
            out.append((start, end))
    return sorted(out)


# ---------------------------------------------------------------- features

_BITS = ("bias", "at", "at_word", "dot_word", "dots1", "dots2", "dots3", "dots_more", "groups1", "groups2", "groups3",
         "groups4", "groups_more", "digits_few", "digits_7_9", "digits_10_15", "digits_14_19", "digits_many", "luhn",
         "octets", "plus", "parens", "dashes", "spaces", "letters_none", "letters_few", "letters_many", "starts_digit",
         "starts_letter", "starts_mark", "ends_digit", "ends_letter", "ends_mark", "cut_left", "cut_right", "mark_left",
         "mark_right", "even_groups", "other_marks", "one_token", "at_inside", "tail_word", "groups_equal_4", "two_words",
         "sentence_dot", "at_first", "long", "zeros_first", "brackets", "spaced_dots", "tail_short", "groups_3_3_4",
         "goes_on_left", "goes_on_right", "digits_left", "digits_right", "only_words",
         "open_end", "free_digits", "odd_marks", "many_ats", "dot_after", "marks_run")


_DIGIT_RUN, _LETTER, _LETTER_RUN = re.compile("[0-9]+"), re.compile(r"[^\W\d_]"), re.compile("[a-z]+")
_ALL_TAIL, _SHORT_TAIL = re.compile("[A-Za-z]+$"), re.compile(r"(?<![A-Za-z])[A-Za-z]{2,6}$")
_AT_FIRST = re.compile(r"[^A-Za-z0-9]*at(?![A-Za-z])", re.IGNORECASE)
_OTHER_MARK = re.compile(r"[^\w \-.+()@%\[\]]")
_TWO_WORDS = re.compile(r"(?<![A-Za-z])(?!(?:at|dot)(?![A-Za-z]))[A-Za-z]+[^\S\n]+(?!(?:at|dot)(?![A-Za-z]))[A-Za-z]", re.IGNORECASE)
_GOES_ON_LEFT = re.compile(r"(?:(?<![A-Za-z])(?:at|dot)|[.@_])[\])> ]{0,3}$", re.IGNORECASE)
_GOES_ON_RIGHT = re.compile(r"[^\S\n]?[\[(<]?(?:(?:at|dot)(?![A-Za-z])|[.@_][\])]?[^\S\n]?[A-Za-z0-9])", re.IGNORECASE)
_FREE_DIGITS = re.compile(r"(?<![A-Za-z0-9_])[0-9]+(?![A-Za-z0-9_])")
_ODD_MARK = re.compile(r"[^\w\s.%+@\[\]()<>-]")
_AT_ANY = re.compile(r"@|(?<![A-Za-z])at(?![A-Za-z])", re.IGNORECASE)
_DOT_AFTER = re.compile(r"(?:@|(?<![A-Za-z])at(?![A-Za-z])).*?(?:[A-Za-z0-9][\])]?\s?[\[(]?\.|(?<![A-Za-z])dot(?![A-Za-z]))", re.IGNORECASE)
_MARKS_RUN = re.compile(r"([^A-Za-z0-9\s])\1")
_OPEN_END = re.compile(r"^(?:[.@]|(?:at|dot)(?![A-Za-z]))|(?:[.@]|(?<![A-Za-z])(?:at|dot))$", re.IGNORECASE)
_DIGITS_LEFT = re.compile(r"[0-9][ .()/\[\]-]{1,3}$")
_DIGITS_RIGHT = re.compile(r"[ .()/\[\]-]{1,3}[0-9]")
_SENTENCE_DOT = re.compile(r"\S\.\s")


def features(text: str, start: int, end: int, n_tokens: int) -> np.ndarray:
    """What the whole span looks like, as 0/1 features."""
    s = text[start:end]
    groups = _DIGIT_RUN.findall(s)
    digits, letters, dots = "".join(groups), len(_LETTER.findall(s)), s.count(".")
    words = set(_LETTER_RUN.findall(s.lower())) if letters else ()
    left, right = text[start - 1:start], text[end:end + 1]
    after = text[end + 1:end + 2]
    n, g = len(digits), len(groups)
    at = s.find("@")
    return np.array((
        True, at >= 0, "at" in words, "dot" in words, dots == 1, dots == 2, dots == 3, dots > 3, g == 1, g == 2, g == 3,
        g == 4, g > 4, 0 < n < 7, 7 <= n <= 9, 10 <= n <= 15, 14 <= n <= 19, n > 19, 14 <= n <= 19 and luhn(digits),
        g == 4 and not letters and all(len(p) < 4 and int(p) < 256 for p in groups),
        s[0] == "+", s.count("(") == 1 == s.count(")"), "-" in s, " " in s, not letters, 0 < letters < 6, letters > 5,
        "0" <= s[0] <= "9", s[0].isalpha(), not s[0].isalnum(), "0" <= s[-1] <= "9", s[-1].isalpha(), not s[-1].isalnum(),
        left.isalnum() or left in "@_" and left != "", right.isalnum() or right in "@_" and right != "",
        left != "" and left in ".-+/:", right != "" and right in ".-/:" and after.isalnum(),
        g > 1 and len({len(p) for p in groups}) == 1, _OTHER_MARK.search(s) is not None,
        n_tokens == 1, 0 < at < len(s) - 1, bool(words) and _ALL_TAIL.search(s) is not None,
        g == 4 and all(len(p) == 4 for p in groups), bool(words) and _TWO_WORDS.search(s) is not None, _SENTENCE_DOT.search(s) is not None,
        bool(words) and _AT_FIRST.match(s) is not None, n_tokens > 12, s[:2] == "00", "[" in s or "(" in s,
        " . " in s, bool(words) and _SHORT_TAIL.search(s) is not None,
        [len(p) for p in groups][-3:] == [3, 3, 4], _GOES_ON_LEFT.search(text, max(0, start - 8), start) is not None,
        _GOES_ON_RIGHT.match(text, end) is not None, _DIGITS_LEFT.search(text, max(0, start - 4), start) is not None,
        _DIGITS_RIGHT.match(text, end) is not None, bool(words) and "." not in s and "@" not in s,
        _OPEN_END.search(s) is not None, _FREE_DIGITS.search(s) is not None, _ODD_MARK.search(s) is not None,
        bool(words) and len(_AT_ANY.findall(s)) > 1, bool(words) and _DOT_AFTER.search(s) is not None, _MARKS_RUN.search(s) is not None), dtype=np.float64)


def possible(text: str, tokens: list[tuple[int, int]], anchor: list[bool], limit: list[int]) -> list[tuple[int, int]]:
    """(first token, last + 1) of the segments that hold an anchor and that some type may have.

    The rest is barred from every type, so it needs no features.  ``limit``:
    the greatest end of the segments from each token on."""
    shown = [text[a:b] for a, b in tokens]
    digit = [t[0] in "0123456789" for t in shown]
    low = [t.lower() for t in shown]
    word = ["a" <= t[0] <= "z" and t not in ("at", "dot") for t in low]
    apart = [False] + [b < c for (_, b), (c, _) in zip(tokens, tokens[1:])]  # white space before the token
    odd = [not (t[0].isalnum() or t in "._%+@[]()<>-") for t in low]
    # An address has one "at" and no other marks than those it is dodged with.  Where none goes on: two words side by side, or a dot that ends a sentence.
    broken = [k > 0 and apart[k] and (word[k] and word[k - 1] or low[k - 1] == "." and k > 1 and not apart[k - 1]) for k in range(len(low))]
    marks = np.array([anchor, [t == "@" or t == "at" for t in low], [t == "." or t == "dot" for t in low],
                      [t[0].isalpha() for t in shown], digit, [len(t) if d else 0 for t, d in zip(shown, digit)], odd, broken],
                     dtype=np.int64).reshape(8, -1)
    sums = np.concatenate([np.zeros((8, 1), np.int64), marks.cumsum(axis=1)], axis=1)
    first = np.arange(len(tokens))
    lengths = np.maximum(np.array(limit, dtype=np.int64) - first, 0)
    i = np.repeat(first, lengths)
    j = np.arange(len(i)) - np.repeat(lengths.cumsum() - lengths, lengths) + i + 1
    held, ats, dots, letters, groups, digits, others = (sums[:7, j] - sums[:7, i])
    inner = np.array([t not in ("at", "dot", ".", "@") for t in low] or [True])  # an address neither begins nor ends with these
    whole = (sums[7, j] == sums[7, i + 1]) & (others == 0) & inner[i] & inner[j - 1] if len(i) else i
    kept = (held > 0) & ((ats == 1) & (dots > 0) & whole | (letters == 0) & ((groups == 4) | (digits >= 7) & (digits <= 19)))
    return list(zip(i[kept].tolist(), j[kept].tolist()))


class Window:
    """A text's part around anchors: its tokens and scored segments."""

    def __init__(self, text: str, low: int, high: int, taken: list[tuple[int, int]],
                 marks: set[tuple[int, int]] | None = None):
        """``taken``: spans that no segment may touch; ``marks``: the text's anchors."""
        self.tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, low, high)]
        free = [all(b <= s or a >= e for a, b in taken) for s, e in self.tokens]
        marks = set(anchors(text)) if marks is None else marks
        anchor = [f and t in marks for t, f in zip(self.tokens, free)]
        n = len(self.tokens)
        limit, stop = [0] * n, n  # no segment from a token on may pass its limit
        for i in range(n - 1, -1, -1):
            if not free[i]:
                stop = i
            elif i + 1 < n and "\n" in text[self.tokens[i][1]:self.tokens[i + 1][0]]:
                stop = i + 1
            limit[i] = min(stop, i + MAX_TOKENS)
        self.segments = possible(text, self.tokens, anchor, limit)
        rows = [features(text, self.tokens[i][0], self.tokens[j - 1][1], j - i) for i, j in self.segments]
        self.x = np.array(rows) if rows else np.empty((0, len(_BITS)))
        has = lambda *names: self.x[:, [_BITS.index(b) for b in names]].any(axis=1)
        bare = has("letters_none")
        typed = (has("at", "at_word") & has("dot_word", "dots1", "dots2", "dots3", "dots_more") & ~has("two_words", "sentence_dot", "open_end", "many_ats", "odd_marks"),
                 bare & has("groups4"),
                 bare & has("digits_14_19"), bare & has("digits_7_9", "digits_10_15"))
        self.barred = np.where(np.array(typed).T, 0.0, -1e4)

    def scores(self, weights: np.ndarray, margin: float = 0.0) -> np.ndarray:
        """(segment, type) scores; a type whose marks a span lacks is barred."""
        return self.x @ weights.T + self.barred - margin

    def spans(self, chosen: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        return [(self.tokens[self.segments[k][0]][0], y, self.tokens[self.segments[k][1] - 1][1]) for k, y in chosen]


def _forward(n: int, ends: list[list[int]], segments, scores: np.ndarray) -> np.ndarray:
    alpha = np.zeros(n + 1)
    for j in range(1, n + 1):
        here = [alpha[j - 1]]
        for k in ends[j]:
            here.extend(alpha[segments[k][0]] + scores[k])
        top = max(here)
        alpha[j] = top + np.log(np.exp(np.array(here) - top).sum())
    return alpha


def _by_end(n: int, segments) -> list[list[int]]:
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j) in enumerate(segments):
        ends[j].append(k)
    return ends


def expected(window: Window, scores: np.ndarray) -> np.ndarray:
    """Posterior of every (segment, type) given all segmentations."""
    n, segments = len(window.tokens), window.segments
    alpha = _forward(n, _by_end(n, segments), segments, scores)
    turned = [(n - j, n - i) for i, j in segments]
    beta = _forward(n, _by_end(n, turned), turned, scores)[::-1]
    i, j = np.array(segments).T
    return np.exp(alpha[i][:, None] + scores + beta[j][:, None] - alpha[n])


def decode(window: Window, scores: np.ndarray) -> list[tuple[int, int]]:
    """(segment, type) of the best segmentation."""
    n, segments = len(window.tokens), window.segments
    ends, best, back = _by_end(n, segments), [0.0] * (n + 1), [None] * (n + 1)
    kinds, tops = scores.argmax(axis=1), scores.max(axis=1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for k in ends[j]:
            s = best[segments[k][0]] + tops[k]
            if s > best[j]:
                best[j], back[j] = s, k
    out, j = [], n
    while j:
        if back[j] is None:
            j -= 1
        else:
            out.append((back[j], int(kinds[back[j]])))
            j = segments[back[j]][0]
    return out[::-1]


# ---------------------------------------------------------------- training

def forms(rng: random.Random, words: list[str]) -> list[tuple[int, str]]:
    """A value of every kind in each form that the patterns miss, as (kind, text)."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: rng.choice(words)
    local = rng.choice((word(), f"{word()}.{word()}", f"{word()}{n(2)}", f"{word()}_{word()}"))
    hosts = [word() for _ in range(rng.randint(1, 3))] + [rng.choice(("com", "org", "net", "de", "info", word()[:3]))]
    host = ".".join(hosts)
    octets = [str(rng.randint(0, 255)) for _ in range(4)]
    while not luhn(card := n(rng.choice((15, 16, 16, 16, 19)))):
        pass
    fours = [card[i:i + 4] for i in range(0, len(card), 4)]
    a, b, c = n(3), n(3), n(4)
    emails = [f"{local} at {' dot '.join(hosts)}", f"{local} at {host}", f"{local} [at] {host}", f"{local}(at){host}",
              f"{local} @ {host}", f"{local.replace('.', ' dot ')} at {' dot '.join(hosts)}", f"{local}[at]{'[dot]'.join(hosts)}",
              f"{local}@{' . '.join(hosts)}", f"{local} (at) {' (dot) '.join(hosts)}"]
    ips = ["[.]".join(octets), " . ".join(octets), "(.)".join(octets), " .".join(octets)]
    cards = [".".join(fours), "  ".join(fours), " - ".join(fours), " - ".join(card), "/".join(fours)]
    phones = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{rng.randint(1, 9)}{n(1)} {a} {b}{c}", f"00{n(2)}-{a}-{b}-{c}",
              f"{a} {b} {c}", " - ".join(a + b + c)]
    return [(k, x) for k, found in enumerate((emails, ips, cards, phones)) for x in found]


def _near_miss(rng: random.Random, words: list[str]) -> str:
    n = "".join(rng.choice("0123456789") for _ in range(20))
    card = n[:16] if not luhn(n[:16]) else n[:15] + str((int(n[15]) + 1) % 10)
    w, m = lambda: rng.choice(words), rng.choice("!%*#?$&|") * 2
    return rng.choice((card, f"{card[:4]} {card[4:8]} {card[8:12]} {card[12:]}", f"{n[:3]}.{300 + int(n[3:5])}.{n[5:7]}.{n[7:9]}",
                       f"{n[0]}.{n[1]}.{n[2]}", f"20{n[:2]}-0{n[2]}-1{n[3]}", f"{n[:2]}:{n[2:4]}", n[:6], f"{n[:3]}-{n[3:7]}",
                       f"{n[:2]} at {n[2:4]}", f"at {n[:4]}", n[:12], n, f"{n[:5]}.{n[5:7]}", f"@{n[:3]}",
                       f"{w()} {w()} at {w()} {w()}. {w()}", f"at {w()}. {w()}", f"{w()} at 1{n[0]}.{n[1]}0", f"{n[:2]}, {n[2:4]}, {n[4:6]}, {n[6:8]}",
                       f"20{n[:2]}.0{n[2]}.1{n[3]} 1{n[4]}:{n[5:7]}", f"{n[:1]},{n[1:4]},{n[4:7]}.{n[7:9]}", f"{n[:4]}-{n[4:8]}", f"{w()}.{w()} at {n[:3]}",
                       f"{n[0]}.{n[1]}.{n[2]}.{n[3]}{n[4]}{n[5]}{n[6]}", f"({n[:4]}) {n[4:6]}", f"{w()}.{w()}.{w()}",
                       f"www.{w()}.com at {w()} {n[:2]}", f"{w()}.{m} at{m} {w()}{m} {w()}", f"{w()},{m} AT{m} {w()}.{m} {w()}{m}",
                       f"{m} at {w()}.{m} {w()}"))


_WORDS = ["word", "other", "name", "place"]  # for windows without any


def examples(windows: list[str], seed: int = 1, values: int = 3) -> list[tuple[Window, np.ndarray]]:
    """Training windows with their gold (segment, type) indicators: each text
    with ``values`` generated ones.  A value that no segment covers is an error."""
    rng, out, waiting = random.Random(seed), [], []
    for text in windows:
        base = base_spans(text)
        words = [w for w in re.findall("[A-Za-z]{3,9}", text) if w.lower() not in ("at", "dot")] or _WORDS
        parts, gold, length, at = [], [], 0, 0

        def say(piece: str, kind: int | None = None) -> None:
            nonlocal length
            if kind is not None:
                gold.append((length, kind, length + len(piece)))  # noqa: B023
            parts.append(piece)  # noqa: B023
            length += len(piece)

        for start, kind, end in base:
            if start < at:
                continue
            say(text[at:start])
            say(text[start:end], kind)
            at = end
        say(text[at:at + CONTEXT])
        for _ in range(values):
            if not waiting:
                waiting = forms(rng, words)
                rng.shuffle(waiting)
            kind, value = waiting.pop()
            lead = rng.choice((" ", ": ", " <", ", ", "\n", " (", '" '))
            say(f" {rng.choice(words)} {_near_miss(rng, words)}, {rng.choice(words)} {rng.choice(words)}{lead}")
            if not base_spans(value):
                say(value, kind)
            say(rng.choice((". ", " ", ", ", ") ", "\n", "; ", '" ')) + f"{rng.choice(words)} {rng.choice(words)}")
        whole = "".join(parts)
        w = Window(whole, 0, len(whole), [])
        y = np.zeros((len(w.segments), len(KINDS)))
        place = {(w.tokens[i][0], w.tokens[j - 1][1]): k for k, (i, j) in enumerate(w.segments)}
        at = -1
        for start, kind, end in gold:
            if start < at:
                continue
            at = end
            if (start, end) in place and w.barred[place[start, end], kind] == 0:
                y[place[start, end], kind] = 1
            elif kind != 0 or "@" not in whole[start:end]:  # a base address may begin or end inside a token
                raise ValueError(f"no segment of type {KINDS[kind]} covers {whole[start:end]!r}")
        if w.segments:
            out.append((w, y))
    return out


def fit(windows: list[str], epochs: int = EPOCHS, penalty: float = 1e-3) -> np.ndarray:
    """Weights (kinds x features) of the greatest segmental likelihood, by AdaGrad."""
    data = examples(windows)
    weights = np.zeros((len(KINDS), len(_BITS)))
    weights[:, 0] = -4.0
    squares = np.full_like(weights, 1e-6)
    for _ in range(epochs):
        for w, y in data:
            step = (y - expected(w, w.scores(weights))).T @ w.x - penalty * weights
            squares += step * step
            weights += 0.6 * step / np.sqrt(squares)
    return weights


def _kind_of(c: str) -> int:
    return 1 if "a" <= c <= "z" or "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 0


def _onward(text: str, at: int, bare: bool) -> int:
    """The end of the tokens after ``at`` that a segment may reach; ``bare``: none with letters."""
    end = at
    for m in islice(_TOKEN.finditer(text, at), MAX_TOKENS - 1):
        if bare and _kind_of(text[m.start()]) == 1 or text.find("\n", end, m.start()) >= 0:
            break
        end = m.end()
    return end


def _back(text: str, at: int, bare: bool) -> int:
    """The start of the tokens before ``at`` that a segment may reach."""
    start = at
    for _ in range(MAX_TOKENS - 1):
        end = start
        while end and text[end - 1].isspace() and text[end - 1] != "\n":
            end -= 1
        if not end or text[end - 1] == "\n":
            break
        kind = _kind_of(text[end - 1])
        if bare and kind == 1:
            break
        start = end - 1
        while kind and start and _kind_of(text[start - 1]) == kind:
            start -= 1
    return start


def added_spans(text: str, base: list[tuple[int, int, int]], weights: np.ndarray,
                margin: float = MARGIN) -> list[tuple[int, int, int]]:
    """(start, kind, end) of segments beside the base spans."""
    taken = [(a, b) for a, _, b in base]
    regions: list[list[int]] = []
    k, reach = 0, 0
    marks = anchors(text)
    for start, end in marks:
        while k < len(taken) and taken[k][0] < end:
            reach = max(reach, taken[k][1])
            k += 1
        if start < reach:
            continue
        # Only a segment with an "at" may hold letters.
        bare = "0" <= text[start] <= "9"
        low, high = _back(text, start, bare), _onward(text, end, bare)
        while regions and low <= regions[-1][1]:  # an "at" may reach back over earlier regions
            before = regions.pop()
            low, high = min(low, before[0]), max(high, before[1])
        regions.append([low, high])
    out, marks = [], set(marks)
    for low, high in regions:
        near = [t for t in taken if t[1] > low and t[0] < high] if taken else []
        w = Window(text, low, high, near, marks)
        if w.segments:
            out += w.spans(decode(w, w.scores(weights, margin)))
    return out


# ---------------------------------------------------------------- Spark

def train(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", train_docs: int = TRAIN_DOCS,
          train_windows: int = TRAIN_WINDOWS) -> np.ndarray:
    """Weights from at most ``train_windows`` windows of the ``train_docs``
    documents with the smallest md5 of their id among those that may hold
    personal data, and on generated values, which alone are left in a table without any."""
    bounded_batches(docs.sparkSession, 128)
    hinted = (docs.select(F.md5(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null"))).alias("key"),
                          F.col(f"`{text}`").alias("text")).where(F.col("text").rlike(_HINT)))
    last = hinted.select("key").orderBy("key").limit(train_docs).agg(F.max("key")).first()[0]
    if last is None:  # generated values in plain words
        return fit([" ".join(_WORDS)] * 40)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, parts = [], [], []
            for key, whole in zip(*(c.to_pylist() for c in batch.columns)):
                done = 0
                found = base_spans(whole) or [(m.start(), 0, m.end()) for m in islice(re.finditer(_HINT, whole), 1)]
                for start, _, end in found:
                    if start >= done and end - start < 200:
                        done = end + CONTEXT
                        keys.append(key)
                        places.append(start)
                        parts.append(whole[max(0, start - CONTEXT):done])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(places, pa.int64()),
                                              pa.array(parts, pa.string())], names=["key", "place", "part"])

    sample = (hinted.where(F.col("key") <= last).mapInArrow(windows, "key string, place long, part string")
              .orderBy("key", "place", "part").limit(train_windows).collect())
    return fit([r["part"] for r in sample])


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", train_docs: int = TRAIN_DOCS,
         train_windows: int = TRAIN_WINDOWS, margin: float = MARGIN, weights: np.ndarray | None = None) -> DataFrame:
    """(doc_id, base, added) of every row: arrays of (start, kind, end, value),
    kinds numbered as in KINDS, code points, end exclusive, sorted.

    * null or empty text: no spans; a null doc_id stays null; repeated rows
      are searched each; empty table: no rows;
    * base spans of different kinds may overlap; added ones touch none.
    """
    if weights is None:
        weights = train(docs, text, doc_id, train_docs, train_windows)
    bounded_batches(docs.sparkSession, 128)
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.string())]))
    ddl = "array<struct<start: long, kind: int, end: long, value: string>>"

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added = [], []
            for whole in batch.column(1).to_pylist():
                whole = whole or ""
                fixed = base_spans(whole)
                more = added_spans(whole, fixed, weights, margin)
                shown = lambda found: [dict(start=a, kind=k, end=b, value=whole[a:b]) for a, k, b in found]  # noqa: B023,E731
                base.append(shown(fixed))
                added.append(shown(more))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(added, span)],
                                             names=["doc_id", "base", "added"])

    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(scanned, f"doc_id long, base {ddl}, added {ddl}"))


@query("op4_semi_markov_pii")
def op4_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                       listed(F.array_sort(F.concat("base", "added"))).alias("spans"))
