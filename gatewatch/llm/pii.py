"""Personal data: exact base patterns, and spans a sequence model adds.

Base spans follow fixed patterns (email, ip, card, phone), leftmost and not
overlapping per kind. Each scanner is linear in the text.

The model is a character-level bidirectional LSTM with CRF transitions, trained
in numpy on labelled spans: base spans of a bounded sample of the documents, keys
that stand there after a word like ``token``, the same spans rewritten in ways the
base patterns miss, and made examples. It finds the base kinds in other writings,
and three kinds that have no base pattern: secrets (keys and passwords), ids
(numbers of persons after a word that says so) and names (after a title or
``name:``). Every span that passes its kind's check holds a trigger (a digit, an
at-mark) or stands next to one (a title, a word like ``password``); windows lie
around all triggers in the whole text and overlap where a run of them is long.
Around an address, a long key or a titled name a window reaches over the whole of
it. All windows of a text are decoded and their spans reconciled together: a span
cut by a window's inner edge yields to the neighbour's, the same span found twice
is one, and of overlapping spans the best scored stay. Model spans must pass the
kind's own check and give way to base spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bilstm_crf import Params, decode, new_params, train
from .common import quoted, table, text_or_empty, utf8_rows, whole_row, with_id

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "id", "name")  # the last three by the model only
Span = tuple[int, int, int]  # kind number, start, end (code points, end exclusive)

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TITLED = r"\b(?:Mr|Mrs|Ms|Dr|Prof)\b\.?|\b[Nn]ame ?:"
TRIGGER = re.compile(r"[0-9@]|\(at\)|\[at\]|(?i:passw|secret|token|api_?key)|" + TITLED)
MARK_BYTES = re.compile(rb"\(at\)|\[at\]|[Pp][Aa][Ss][Ss][Ww]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]|" + TITLED.encode())
AT = re.compile(r"@|\(at\)|\[at\]")
SITE = re.compile(r" ?[A-Za-z0-9-]+(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]+)+")

# What windows are not to cut: keys, and names after a title; and keys that label the sample.
KEYLIKE = re.compile(r"[A-Za-z0-9+/_.=-]+")
LONGEST_KEY = 256
NAMED = re.compile(f"(?:{TITLED}) ?(?:[^\\W\\d_][\\w'-]*\\.? ?){{1,4}}")
BEFORE_NAME = re.compile(f"(?:{TITLED}) ?$")
ASSIGNED = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']? {0,4}[:=] {0,4}["']?([A-Za-z0-9+/_.=-]{8,})""")
KEY = re.compile(r"AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}|[0-9A-F]{32,}")

# Windows: characters around a trigger, the longest window, and the overlap.
AROUND, WINDOW, OVERLAP = 20, 96, 40
# What an address can have on either side of its at-mark: 64 octets of name, or a
# domain of 255 octets, 127 labels with " (dot) " between them (RFC 5321).
REACH = 1024
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
SPECIAL = "@.+-() _%/:=\"',;#\n"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind and start."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))
    for m in DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i : i + 4]
            end = at + sum(map(len, own)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in own):
                out.append((1, at, end))
            at = end + 1
    for m in DIGITS.finditer(text):
        digits = digits_of(m.group()) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PLUS.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def plausible(kind: int, text: str) -> bool:
    """The kind's own check of a model span."""
    if kind == 0:
        return re.fullmatch(r"[^\s@]+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]+(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]+)+", text) is not None
    digits = digits_of(text)
    if kind == 1:
        parts = re.split(r"[^0-9]+", text)
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == 3:
        return 8 <= len(digits) <= 15 and re.fullmatch(r"[+(]?[0-9][0-9 ().\-/]+[0-9]", text) is not None and not digits == text
    if kind == 4:
        return re.fullmatch(r"[A-Za-z0-9+/_.=~!#$%&*^-]{8,1024}", text) is not None and bool(digits) and len(digits) < len(text)
    if kind == 5:
        return len(digits) >= 4 and re.fullmatch(r"[A-Z0-9][A-Z0-9 -]{4,32}[A-Z0-9]", text) is not None
    return text[:1].isupper() and re.fullmatch(r"[^\W\d_][\w'-]*\.?(?: [^\W\d_][\w'-]*\.?){0,3}", text) is not None


def _plain_codes() -> np.ndarray:
    out = np.full(128, 31, np.int64)
    for i in range(128):
        c = chr(i)
        if "0" <= c <= "9":
            out[i] = 1
        elif "a" <= c <= "z":
            out[i] = 2 + (i - 97)
        elif "A" <= c <= "Z":
            out[i] = 28
        elif c in SPECIAL:
            out[i] = 32 + SPECIAL.index(c)
        elif c.isspace():
            out[i] = 30
    return out


PLAIN = _plain_codes()


def char_codes(text: str) -> np.ndarray:
    """Codes of characters: digits alike, letters by case with a few classes, signs apart."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = PLAIN[np.minimum(points, 127)]
    for i in np.flatnonzero(points > 127).tolist():
        c = text[i]
        out[i] = 29 if c.isalpha() else 30 if c.isspace() else 31
    return out


VOCABULARY = 32 + len(SPECIAL)


def addresses(text: str) -> list[tuple[int, int]]:
    """Ranges of the names and domains around at-marks, spaced or not."""
    out, done = [], 0
    for m in AT.finditer(text):
        site = SITE.match(text, m.end(), m.end() + REACH)
        before = text[max(done, m.start() - REACH) : m.start()]
        name = re.split(r"[\s@]", before.removesuffix(" "))[-1]
        if site and name:
            out.append((m.start() - len(name) - before.endswith(" "), site.end()))
        done = m.end()
    return out


def windows(text: str) -> list[tuple[int, int]]:
    """Ranges that cover every trigger with its surroundings; longer runs of
    triggers are cut into overlapping ranges; addresses, keys and titled names are
    not cut."""
    out: list[tuple[int, int]] = []
    lo = hi = -1
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if hi >= 0 and a <= hi:
            hi = b
        else:
            if hi >= 0:
                out.append((lo, hi))
            lo, hi = a, b
    if hi >= 0:
        out.append((lo, hi))
    cut = [(a, min(a + WINDOW, hi)) for lo, hi in out for a in range(lo, max(lo + 1, hi - OVERLAP), WINDOW - OVERLAP)]
    at, grown = 0, []
    whole = addresses(text) + [m.span() for m in NAMED.finditer(text)]
    whole += [m.span() for m in KEYLIKE.finditer(text) if 16 <= m.end() - m.start() <= LONGEST_KEY and any("0" <= c <= "9" for c in m.group())]
    for a, b in sorted(whole):
        while at < len(cut) and cut[at][1] < b:
            at += 1
        # a window that holds it off its inner edges serves it
        near = cut[max(at - 1, 0) : at + 3]
        if not any((lo < a or lo == 0) and (b < hi or hi == len(text)) for lo, hi in near):
            grown.append((max(0, a - AROUND), min(len(text), b + AROUND)))
    return sorted(cut + grown)


def known_keys(text: str) -> list[Span]:
    """Keys of a sample text that label it: after an assigning word, or by form."""
    out = [(4, *m.span(1)) for m in ASSIGNED.finditer(text)]
    return out + [(4, *m.span()) for m in KEY.finditer(text)]


def labelled(spans: list[Span], lo: int, hi: int) -> np.ndarray:
    """Tags of the characters from ``lo`` to ``hi``; earlier spans win."""
    tags = np.zeros(hi - lo, np.int64)
    for kind, a, b in spans:
        if a >= lo and b <= hi and not tags[a - lo : b - lo].any():
            tags[a - lo : b - lo] = 2 + 2 * kind
            tags[a - lo] = 1 + 2 * kind
    return tags


def labelled_windows(text: str) -> Iterator[tuple[str, np.ndarray]]:
    """The windows of a text with the tags of its known spans."""
    known = base_spans(text) + known_keys(text)
    by_start = sorted(range(len(known)), key=lambda k: known[k][1])
    starts = [known[k][1] for k in by_start]
    for lo, hi in windows(text):
        inside = sorted(by_start[bisect_left(starts, lo) : bisect_left(starts, hi)])  # base spans come first
        yield text[lo:hi], labelled([known[k] for k in inside], lo, hi)


def spans_of(path: np.ndarray, lead: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(kind, start, end, score) of the runs of a tag path."""
    out, i = [], 0
    while i < len(path):
        t = int(path[i])
        if t == 0:
            i += 1
            continue
        kind, j = (t - 1) // 2, i + 1
        while j < len(path) and path[j] == 2 + 2 * kind:
            j += 1
        out.append((kind, i, j, float(lead[i:j].mean())))
        i = j
    return out


def reconcile(text: str, found: list[tuple[int, int, int, float, int, int]], base: list[Span]) -> list[Span]:
    """Model spans of a text: whole, plausible, not overlapping. ``found`` holds
    (kind, start, end, score, window start, window end)."""
    whole = [(score, k, a, b) for k, a, b, score, lo, hi in found
             if (a > lo or lo == 0) and (b < hi or hi == len(text)) and plausible(k, text[a:b])
             and (KINDS[k] != "name" or BEFORE_NAME.search(text, max(0, a - 12), a))]
    starts: list[int] = []  # disjoint ranges that are taken
    ends: list[int] = []
    for _, a, b in sorted(base, key=lambda x: x[1]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a), ends.append(b)
    out: list[Span] = []
    for _, k, a, b in sorted(set(whole), key=lambda w: (-w[0], w[1:])):
        at = bisect_right(ends, a)  # the first range that ends after a
        if at == len(starts) or b <= starts[at]:
            starts.insert(at, a), ends.insert(at, b)
            out.append((k, a, b))
    return out


def rewritten(rng: np.random.Generator, kind: int, text: str) -> str:
    """The same datum as the base patterns would miss it."""
    if kind == 3:
        bare = text.lstrip("+")
        return str(rng.choice([bare, bare.replace(" ", "."), "(0" + bare[:2] + ") " + bare[2:], bare.replace(" ", "/")]))
    if kind == 2:
        d = digits_of(text)
        groups = [d[i : i + 4] for i in range(0, len(d), 4)]
        return str(rng.choice([".".join(groups), "/".join(groups), " - ".join(groups), d[:15] if luhn(d[:15]) else "_".join(groups)]))
    if kind == 1:
        return text.replace(".", str(rng.choice(["-", " . ", "[.]", ":"])))
    return text.replace("@", str(rng.choice([" @ ", "(at)@", " @", "@ "])))


def made_examples(seed: int = 5, n: int = 700) -> list[tuple[str, list[Span]]]:
    """Labelled texts from rules: data among letters, and numbers that are none."""
    rng = np.random.default_rng(seed)

    def word() -> str:
        return "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))

    def number(k: int) -> str:
        return "".join(str(c) for c in rng.integers(0, 10, k))

    def card() -> str:
        d = "4" + number(14)
        return next(d + str(c) for c in range(10) if luhn(d + str(c)))

    out = []
    for _ in range(n):
        kind = int(rng.integers(0, 5))
        if kind == 0:
            datum = f"{word()}.{number(2)}@{word()}{number(1)}.example.{rng.choice(['com', 'net', 'org'])}"
        elif kind == 1:
            datum = ".".join(str(int(x)) for x in rng.integers(1, 256, 4))
        elif kind == 2:
            datum = card()
            if rng.random() < 0.5:
                datum = str(rng.choice([" ", "-"])).join(datum[i : i + 4] for i in range(0, 16, 4))
        elif kind == 3:
            datum = f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}"
        else:
            datum = str(rng.choice([f"{number(1)}.{number(1)}.", number(4), f"{word()}={number(3)}", f"{word()}-{number(2)}",
                                    f"{number(2)}.{number(2)}.{number(4)}", number(20), f"{number(3)},{number(3)}", f"v{number(1)}.{number(1)}"]))
        if kind < 4 and rng.random() < 0.4:
            datum = rewritten(rng, kind, datum)
        before = " ".join(word() for _ in range(rng.integers(1, 5))) + " "
        text = before + datum + str(rng.choice([" ", ". ", ", ", "\n"])) + " ".join(word() for _ in range(rng.integers(1, 5)))
        out.append((text, [(kind, len(before), len(before) + len(datum))] if kind < 4 else []))
    return out


def long_examples(seed: int = 6, n: int = 300) -> list[tuple[str, list[Span]]]:
    """Labelled texts from rules: e-mails with long names and domains, spaced or
    with the marks written out, and at-marks in prose."""
    rng = np.random.default_rng(seed)

    def word(least: int = 2, most: int = 14) -> str:
        return "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(least, most)))

    def prose() -> str:
        return " ".join(word(2, 9) for _ in range(rng.integers(1, 6)))

    out = []
    for _ in range(n):
        if rng.random() < 0.3:
            odd = str(rng.choice([f"{word()} (at) {word()}", f"{word()} @ {word()}", f"{word()} [at] {word()}, {word()}", f"{word()} @ {rng.integers(1, 99)}",
                                  f"{word()} (dot) {word()}", f"@{word()}"]))
            out.append((f"{prose()} {odd} {prose()}", []))
            continue
        name = str(rng.choice([".", "_", "-"])).join(word() for _ in range(rng.integers(1, 4)))
        mark = str(rng.choice([" @ ", " @ ", " @", "@ ", " (at) ", "(at)", " [at] ", "[at]"]))
        dot = str(rng.choice([" (dot) ", "(dot)", " [dot] ", "[dot]", ".", " . "])) if "at" in mark else "."
        labels = [word() if rng.random() < 0.7 else f"{word()}-{word()}" for _ in range(rng.integers(1, 4))]
        datum = name + mark + dot.join([*labels, str(rng.choice(["com", "net", "org", "de"]))])
        before = prose() + " " if rng.random() < 0.9 else ""
        text = before + datum + str(rng.choice([" ", ", ", "\n", ""]))
        if text[-1] in " \n":
            text += prose()
        out.append((text, [(0, len(before), len(before) + len(datum))]))
    return out


def secret_examples(seed: int = 8, n: int = 900) -> list[tuple[str, list[Span]]]:
    """Labelled texts from rules: keys and passwords, ids and names in their
    contexts, and look-alikes that are none."""
    rng = np.random.default_rng(seed)
    pick = lambda *of: str(rng.choice(list(of)))

    def some(alphabet: str, least: int, most: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(least, most + 1)))

    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    word = lambda most=9: some(lower, 2, most)
    capital = lambda: word().capitalize()
    prose = lambda: " ".join(word() if rng.random() < 0.9 else capital() for _ in range(rng.integers(1, 6)))

    def key() -> str:
        kind = rng.integers(0, 6)
        if kind == 0:
            return some(digits + "abcdef", 32, 64)
        if kind == 1:
            return some(digits + "ABCDEF", 32, 64)
        if kind == 2:
            return "AKIA" + some(digits + lower.upper(), 12, 16)
        if kind == 3:
            return pick("ghp_", "sk_live_", "xoxb-", "") + some(digits + lower + lower.upper(), 24, 40)
        return some(digits + lower + lower.upper() + "+/", 20, 44) + pick("", "=", "==")

    out = []
    for _ in range(n):
        kind = int(rng.integers(0, 10))
        before, span = prose() + pick(" ", "\n", ", ", ": "), None
        if kind < 4:
            name = pick("password", "passwd", "secret", "token", "api_key", "apikey", "access token", "client_secret", "API key")
            datum = key() if rng.random() < 0.75 else some(lower, 3, 8) + some(digits, 1, 4) + pick("", "!", "_" + word())
            before += (name.upper() if rng.random() < 0.15 else name) + pick(" = ", "=", ": ", ":", " : ", " is ") + pick("", '"', "'")
            span = (4, len(datum) >= 8)
        elif kind < 5:
            datum, span = key(), (4, True)
        elif kind < 6:
            before += pick("SSN ", "ssn: ", "social security number ", "passport no. ", "passport number: ", "IBAN ", "national id ", "driver licence ")
            datum = pick(f"{some(digits, 3, 3)}-{some(digits, 2, 2)}-{some(digits, 4, 4)}", some(lower.upper(), 1, 2) + some(digits, 7, 8),
                         some(lower.upper(), 2, 2) + some(digits, 2, 2) + "".join(" " + some(digits, 4, 4) for _ in range(4)))
            span = (5, True)
        elif kind < 7:
            before += pick("Mr. ", "Mrs. ", "Ms. ", "Dr. ", "Prof. ", "Mr ", "Dr ", "Name: ", "name: ", "name : ")
            datum, span = " ".join(capital() for _ in range(rng.integers(1, 4))), (6, True)
        else:
            datum = pick(f"{pick('password', 'secret', 'token', 'api key')} {prose()}", f"token {some(digits, 1, 4)}", f"name: {pick('none', 'n/a', '12')}",
                         f"https://{word()}.example/{some(digits, 4, 4)}/{word()}-{word()}-{word()}", f"order {some(digits, 3, 3)}-{some(digits, 4, 4)}",
                         f"ISBN 978-{some(digits, 1, 1)}-{some(digits, 2, 2)}-{some(digits, 6, 6)}-{some(digits, 1, 1)}", some(lower, 14, 30),
                         some(lower.upper(), 14, 30), f"{word()}{word()}{word()}{some(digits, 1, 2)}", f"page {some(digits, 1, 3)}", some(digits, 16, 20))
        after = pick("", '"', "'", ".", ",") + pick(" ", "\n") + prose()
        spans = [(span[0], len(before), len(before) + len(datum))] if span and span[1] else []
        out.append((before + datum + after, spans))
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = 10_000, max_windows: int = 600,
        epochs: int = 10) -> Params:
    """The trained parameters. The sample is bounded: about ``max_docs``
    documents by a hash of the id, of their windows at most ``max_windows`` by a
    hash of the window. Made examples join them, so an empty table trains too."""
    share = max_docs / max(docs.count(), 1)
    sample = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    if share < 1:
        sample = sample.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, tags = [], []
            for value in batch.column(0):
                for part, own in labelled_windows(value.as_py()):
                    texts.append(part)
                    tags.append(own.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(tags, pa.list_(pa.int32()))], names=["text", "tags"])

    own = sample.where(F.col("text").rlike(TRIGGER.pattern)).select("text").mapInArrow(work, "text string, tags array<int>")
    rows = own.orderBy(F.xxhash64("text"), "text", "tags").limit(max_windows).collect()
    rng = np.random.default_rng(11)
    texts = [r.text for r in rows]
    tags = [np.array(r.tags, np.int64) for r in rows]
    for r in rows:  # the same windows with a datum rewritten
        for kind, a, b, _ in spans_of(np.array(r.tags), np.zeros(len(r.tags)))[:1]:
            if kind < len(BASE_KINDS) and rng.random() < 0.3:
                new = rewritten(rng, kind, r.text[a:b])
                text = r.text[:a] + new + r.text[b:]
                texts.append(text)
                tags.append(labelled([(kind, a, a + len(new))], 0, len(text)))
    for text, spans in made_examples() + long_examples() + secret_examples():
        texts.append(text)
        tags.append(labelled(spans, 0, len(text)))
    return train(new_params(VOCABULARY, TAGS), [char_codes(t) for t in texts], tags, epochs)


SPANS = "array<struct<kind:int,start:bigint,end:bigint,base:boolean>>"


def without(text: str, spans: list[dict]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping
    spans the first and longest stands for all."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def private_spans(docs: DataFrame, model: Params, id_col: str = "doc_id", text_col: str = "text", redacted: bool = False) -> DataFrame:
    """(id, spans): one row per row of ``docs``; spans by kind and start. With
    ``redacted`` also the text without them, null where there is none.

    Null and empty texts have none; repeated rows are kept; a null id keeps its
    row; other columns are not read."""
    trigger = np.zeros(256, bool)
    trigger[[*range(0x30, 0x3A), 0x40]] = True
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8_rows(batch.column(1))
            marks = np.fromiter((m.start() for m in MARK_BYTES.finditer(raw)), np.int64)
            places = np.concatenate((np.flatnonzero(trigger[raw]), marks))
            held = np.flatnonzero(np.bincount(np.searchsorted(at, places, side="right") - 1, minlength=len(at) - 1))
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            texts: list[str | None] = [None] * batch.num_rows
            rows: list[tuple[int, str, list[Span], list[tuple[int, int]]]] = []
            waiting = 0

            def settle() -> None:
                codes = [char_codes(t[lo:hi]) for _, t, _, ws in rows for lo, hi in ws]
                paths = iter(decode(model, codes))
                for r, text, base, ws in rows:
                    found = []
                    for lo, hi in ws:
                        path, lead = next(paths)
                        found += [(k, lo + a, lo + b, s, lo, hi) for k, a, b, s in spans_of(path, lead)]
                    added = reconcile(text, found, base)
                    spans[r] = [{"kind": k, "start": a, "end": b, "base": is_base}
                                for k, a, b, is_base in sorted([(*s, True) for s in base] + [(*s, False) for s in added])]
                    if redacted and spans[r]:
                        texts[r] = without(text, spans[r])
                rows.clear()

            for r in held.tolist():
                text = raw[at[r] : at[r + 1]].tobytes().decode()
                ws = windows(text)
                rows.append((r, text, base_spans(text), ws))
                waiting += len(ws)
                if waiting > 2000:
                    settle()
                    waiting = 0
            settle()
            columns = {"id": batch.column(0), "spans": pa.array(spans, kind)} | ({"redacted": pa.array(texts, pa.string())} if redacted else {})
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col)).mapInArrow(
        work, with_id(docs, id_col, f"spans {SPANS}" + (", redacted string" if redacted else "")))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs``, all columns, with every span of a text replaced by its kind in
    brackets (overlapping spans by that of the first and longest), and the length column, where
    there is one, set anew for changed texts. Null texts stay null."""
    model = fit(docs, id_col, text_col)
    packed = docs.select(whole_row(docs).alias("row"), F.col(text_col).alias("text"))
    out = private_spans(packed, model, "row", "text", redacted=True).select("id", F.col("redacted").alias("new"))
    text = F.coalesce(F.col("new"), F.col(f"id.{quoted(text_col)}"))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(text.alias(c))
        elif c == length_col:
            kind = docs.schema[c].dataType
            columns.append(F.when(F.col("new").isNotNull(), F.length("new").cast(kind)).otherwise(F.col(f"id.{quoted(c)}")).alias(c))
        else:
            columns.append(F.col(f"id.{quoted(c)}").alias(c))
    return out.select(*columns)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every row of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    found = private_spans(docs, fit(docs))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind: int):
        spans = base if kind < len(BASE_KINDS) else F.col("spans")
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        F.col("id").alias("doc_id"), *map(count, range(len(BASE_KINDS))), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), *map(count, range(len(BASE_KINDS), len(KINDS))), F.size("spans").cast("long").alias("n_spans"))
