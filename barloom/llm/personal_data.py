"""Personal data: fixed patterns, and further spans that weak labelers vote for.

Fixed patterns give the base spans. Wider patterns give candidates: addresses written with "at" and "dot", numbers
without a country code, card numbers inside longer chains of digits, long network addresses, bank and
national numbers, names after a title or an introduction. Labelers of three sorts vote on each candidate and
each base span, for, against or not at all: by form and check digits (regex), by lists (gazetteer), and by the
words around it (context).

No label is given. How reliable each labeler is, per kind, is estimated by expectation-maximisation over
the counts of all vote patterns of the whole corpus (a pattern is one number, so there are few). The
posteriors train a logistic classifier of votes and shape on a bounded sample of spans; it accepts
or rejects every candidate. Base spans always stay.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from barloom.llm.arrow_text import settle_texts, with_columns_in_arrow
from barloom.session import ship_package

KINDS = ("email", "ip", "card", "phone", "account", "person")
EMAIL, IP, CARD, PHONE, ACCOUNT, PERSON = range(len(KINDS))
#: Spans of a kind that the classifier is trained on at most, chosen by a hash.
SAMPLE_PER_KIND = 4096
ACCEPTED = 0.5
EM_STEPS = 60
#: Weight of the assumed votes, as a share of all spans of a kind.
ASSUMED = 0.002
#: Code points before and after a span that context labelers read.
AROUND = 48

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SPELLED_AT = re.compile(r"\s?[\[({]\s?at\s?[\])}]\s?|\sat\s|\s@\s", re.IGNORECASE)
#: Texts in which that can be followed by a domain, for a quick first test.
_SPELLED = r"@|(?i:[\[({]\s?at\s?[\])}]|\sat\s[a-z0-9-]+(?:\.[a-z0-9]|\s?[\[({]?\s?dot[\s\])}]))"
SPELLED_DOMAIN = re.compile(
    r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)[A-Za-z0-9-]{1,63}){1,5}", re.IGNORECASE)
LONG_ADDRESS = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::(?:[0-9A-Fa-f]{1,4}:){0,5})?[0-9A-Fa-f]{1,4}(?![\w:])")
NATIONAL = re.compile(r"(?<![\w.+/-])(?:\([0-9]{2,5}\)[\x20.-]?|00?[1-9][0-9]{1,4}[\x20./-]|[2-9][0-9]{2}[\x20.-])"
                      r"[0-9]{3,4}(?:[\x20.-]?[0-9]{2,4}){1,3}(?![\w-])")
BANK = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
CITIZEN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NAME = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'’-]{1,30}"
_TITLE = (r"\b(?:Mrs?|Ms|Miss|Dr|Prof|Herr|Frau|Señora?|Sra?|Don|Doña|Monsieur|Madame|Mme)\.?\x20|"
          r"\b(?:[Mm]y name is|[Mm]ein Name ist|[Ii]ch heiße|[Mm]e llamo|[Mm]i nombre es|[Jj]e m['’]appelle|"
          r"[Mm]on nom est|Name:|Nombre:|Nom:|Signed,?|Sincerely,?)\s")
NAMED = re.compile(rf"(?:{_TITLE})({_NAME}(?:\x20{_NAME}){{0,2}})")

# What the labelers look up.
ENDINGS = frozenset("com org net edu gov io info biz de at ch fr es it uk eu us ca au mx nl be pt pl se".split())
FILES = frozenset("png jpg jpeg gif svg pdf zip html htm js css py txt doc exe php xml json".split())
COUNTRIES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 "
                      "63 64 65 66 81 82 84 86 90 91 92 94 98 351 352 353 354 358 420 421".split())
BANKS = frozenset("AD AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO "
                  "SE SI SK SM TR".split())
FIRST_NAMES = frozenset(
    "James Mary John Patricia Robert Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Thomas "
    "Sarah Charles Karen Daniel Lisa Anna Peter Hans Klaus Jürgen Wolfgang Ursula Monika Petra Sabine Stefan "
    "Andreas Martin María Carmen José Antonio Manuel Francisco Juan Javier Luis Carlos Ana Isabel Laura Pedro "
    "Jean Pierre Michel Marie Jacques Nathalie Isabelle Philippe François Sophie Camille Julien Nicolas".split())
FOR = {
    EMAIL: r"e-?mail|mail|contact|write|reach|correo|courriel|kontakt|schreib", IP: r"\bip|address|host|server|login|client|adresse",
    CARD: r"card|visa|master|amex|credit|debit|karte|tarjeta|carte|payment|cvv|expir",
    PHONE: r"phone|tel|call|mobile|fax|cell|dial|ruf|llama|appel|móvil|handy|whatsapp",
    ACCOUNT: r"iban|account|konto|cuenta|compte|ssn|social|security|steuer|tax|\bid\b", PERSON: r"name|dear|signed|sincerely|regards"}
AGAINST = re.compile(r"version|\bv\.?\s*$|isbn|issn|order|invoice|sku|serial|article|\bpart|page|vol\.|figure|fig\.|table|"
                     r"section|chapter|build|release|rechnung|factura|facture|total|price|\bno\.\s*$", re.IGNORECASE)
_FOR = {kind: re.compile(words, re.IGNORECASE) for kind, words in FOR.items()}
UNIT = re.compile(r"\s?(?:%|€|\$|£|°|kg|km|cm|mm|mb|gb|eur|usd)(?!\w)", re.IGNORECASE)
_OTHER_NUMBERS = re.compile(r"[0-9]+(?:[.,][0-9]+)?")

LABELERS = ("form", "check", "list", "cue", "against", "edges", "numbers")
PATTERNS = 3 ** len(LABELERS)
SHAPE = ("length", "digits", "letters", "signs", "distinct", "letter_before", "letter_after", "line_start")


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches in linear time: each sign is met once, and its name is read backwards to the
    last match or the first character that no name has."""
    past = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            past = domain.end()
            yield start, past
        else:
            past = at + 1
        at = text.find("@", past)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order."""
    found = []
    if "@" in text:
        found += [(a, EMAIL, b) for a, b in emails(text)]
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), IP, m.end()))
    for m in CHAIN.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            found.append((m.start(), CARD, m.end()))
    if "+" in text:
        found += [(m.start(), PHONE, m.end()) for m in DIALLED.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def _cards_in_chain(start: int, chain: str) -> Iterator[tuple[int, int]]:
    """Runs of whole groups of a chain that have as many digits as a card and pass its check, from the left;
    cards have no group of fewer than three digits."""
    groups = [(m.start(), m.end()) for m in re.finditer("[0-9]+", chain)]
    first = 0
    while first < len(groups):
        digits, last = 0, first
        while last < len(groups) and digits < 19 and groups[last][1] - groups[last][0] >= 3:
            digits += groups[last][1] - groups[last][0]
            a, b = groups[first][0], groups[last][1]
            last += 1
            if 13 <= digits <= 19 and luhn(_digits(chain[a:b])):
                yield start + a, start + b
                first = last - 1
                break
        first += 1


def wider_spans(text: str, digits: bool, spelled: bool, named: bool) -> Iterator[tuple[int, int, int]]:
    """``(start, kind, end)`` of the wider patterns; the flags say which of them can occur at all."""
    if spelled:
        past = 0
        for m in SPELLED_AT.finditer(text):
            start = m.start()
            while start > max(past, m.start() - 64) and text[start - 1] in LOCAL:
                start -= 1
            domain = SPELLED_DOMAIN.match(text, m.end()) if start < m.start() else None
            if domain:
                past = domain.end()
                yield start, EMAIL, past
    if named:
        yield from ((m.start(1), PERSON, m.end(1)) for m in NAMED.finditer(text))
    if digits:
        for m in CHAIN.finditer(text):
            if m.end() - m.start() >= 13:
                yield from ((a, CARD, b) for a, b in _cards_in_chain(m.start(), m[0]))
        yield from ((m.start(), PHONE, m.end()) for m in NATIONAL.finditer(text) if 7 <= len(_digits(m[0])) <= 15)
        yield from ((m.start(), ACCOUNT, m.end()) for p in (BANK, CITIZEN) for m in p.finditer(text))
        if ":" in text:
            yield from ((m.start(), IP, m.end()) for m in LONG_ADDRESS.finditer(text))


def _vote(yes: bool, no: bool) -> int:
    return 1 if yes else -1 if no else 0


def _checked(kind: int, value: str, digits: str) -> int:
    """Check digits, ranges and lengths."""
    if kind == CARD:
        return _vote(luhn(digits), True)
    if kind == ACCOUNT:
        if value[:1].isdigit():
            return _vote(value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00", True)
        plain = value.replace(" ", "")
        return _vote(int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1, True)
    if kind == IP:
        parts = value.split("." if "." in value else ":")
        if ":" in value:
            return _vote(len(parts) == 8 or "::" in value, True)
        return _vote(all(p == "0" or p[0] != "0" for p in parts), True)
    if kind == PHONE:
        return _vote(9 <= len(digits) <= 13, len(digits) < 8 or len(set(digits)) < 3)
    if kind == EMAIL:
        return _vote(2 <= len(value) - 1 - value.rfind(".") <= 24 and value[-1].isalpha(), value[-1].isdigit())
    return _vote(" " in value, False)


def _listed(kind: int, value: str, digits: str) -> int:
    if kind == EMAIL:
        end = re.split(r"[.\s\])}]", value.lower())[-1]
        return _vote(end in ENDINGS, end in FILES)
    if kind == PHONE:
        known = value[0] == "+" and any(digits[:n] in COUNTRIES for n in (1, 2, 3))
        return _vote(known, value[0] == "+")
    if kind == CARD:
        return _vote(digits[0] in "3456", digits[0] in "01")
    if kind == IP:
        return _vote(False, value.startswith(("0.", "127.", "255.")) or (":" in value and not any(c.isalpha() for c in value)))
    if kind == ACCOUNT:
        return _vote(value[:2] in BANKS, value[:1].isalpha())
    return _vote(value.split(" ")[0] in FIRST_NAMES, False)


def votes(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """What each labeler says of a span, 1, 0 or -1."""
    value = text[start:end]
    digits = _digits(value)
    before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
    strict = {EMAIL: "@" in value and " " not in value, PHONE: value[0] in "+(", IP: len(value) >= 7,
              CARD: len(digits) == 16, ACCOUNT: value[0].isalpha(), PERSON: value.count(" ") == 1}[kind]
    joined = (before[-1:].isalnum() or after[:1].isalnum() or before[-1:] in ("_", "/", "=", "#")
              or after[:1] in ("_", "/", "="))
    numbers = len(_OTHER_NUMBERS.findall(before)) + len(_OTHER_NUMBERS.findall(after))
    return (_vote(strict, False), _checked(kind, value, digits), _listed(kind, value, digits),
            _vote(_FOR[kind].search(before) is not None, False), _vote(False, AGAINST.search(before) is not None),
            _vote(not joined and (not before or before[-1].isspace()), joined or UNIT.match(after) is not None),
            _vote(numbers == 0, kind not in (PERSON, EMAIL) and numbers > 6))


def shape(text: str, start: int, end: int) -> list[float]:
    value = text[start:end]
    n = len(value)
    return [np.log1p(n), sum(c.isdigit() for c in value) / n, sum(c.isalpha() for c in value) / n,
            sum(not c.isalnum() for c in value) / n, len(set(value)) / min(n, 32),
            float(text[start - 1:start].isalnum()), float(text[end:end + 1].isalnum()),
            float(start == 0 or text[start - 1] == "\n")]


def pattern_of(said: tuple[int, ...]) -> int:
    return sum((v + 1) * 3 ** i for i, v in enumerate(said))


def votes_of(pattern: np.ndarray) -> np.ndarray:
    """The votes of each pattern, one column per labeler."""
    return pattern[:, None] // 3 ** np.arange(len(LABELERS))[None, :] % 3 - 1


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


SPAN = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType()),
    T.StructField("base", T.BooleanType()), T.StructField("pattern", T.IntegerType()),
    T.StructField("shape", T.ArrayType(T.FloatType()))])
COUNTS = ("n_email", "n_ip", "n_card", "n_phone")
SCANNED = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]
                       + [T.StructField("base_sha256", T.StringType()), T.StructField("found", T.ArrayType(SPAN))])
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("base", pa.bool_()),
                            ("pattern", pa.int32()), ("shape", pa.list_(pa.float32()))]))


def scan(texts: pa.Array) -> list[pa.Array]:
    """The columns of ``SCANNED``: the base spans, and all spans with votes and shape."""
    can = [pc.match_substring_regex(texts, p).to_pylist() for p in (
        "[0-9]", _SPELLED, _TITLE)]
    columns: list[list] = [[] for _ in SCANNED]
    for text, digits, spelled, named in zip(texts.to_pylist(), *can):
        base = base_spans(text) if digits or spelled else []
        spans = [(s, k, e, True) for s, k, e in base]
        starts = [s for s, _, _ in base]
        furthest = list(accumulate((e for _, _, e in base), max))
        for s, k, e in wider_spans(text, digits, spelled, named):
            at = bisect.bisect_right(starts, s) - 1
            if at < 0 or furthest[at] < e:           # not inside a base span
                spans.append((s, k, e, False))
        kinds = [k for _, k, _ in base]
        for column, kind in zip(columns, range(4)):
            column.append(kinds.count(kind))
        columns[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
        columns[5].append([{"start": s, "kind": k, "end": e, "base": b, "pattern": pattern_of(votes(text, s, k, e)),
                            "shape": shape(text, s, e)} for s, k, e, b in spans])
    return [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string(), _SPAN])]


def reliabilities(pattern: np.ndarray, count: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, float, np.ndarray]:
    """Expectation-maximisation over counted vote patterns of one kind.

    Returns how often each labeler says -1, 0, 1 on true and on false spans, the share of true ones, and the
    posterior of each pattern. The first posteriors are those of the majority; a few assumed votes
    that agree with the truth keep the two classes from changing places.
    """
    said = votes_of(pattern)
    one_hot = (said[:, :, None] == np.array([-1, 0, 1])[None, None, :]).astype(float)
    posterior = 1 / (1 + np.exp(-said.sum(axis=1).astype(float)))
    assumed = np.array([[2.0, 2.0, 1.0], [1.0, 2.0, 2.0]]) * max(1.0, ASSUMED * count.sum())   # false, true
    table, share = np.zeros((2, len(LABELERS), 3)), 0.5
    for _ in range(steps):
        for y, p in enumerate((1 - posterior, posterior)):
            seen = np.einsum("p,plv->lv", p * count, one_hot) + assumed[y][None, :]
            table[y] = seen / seen.sum(axis=1, keepdims=True)
        share = float((posterior @ count + 1) / (count.sum() + 2))
        logs = np.einsum("plv,ylv->py", one_hot, np.log(table)) + np.log([1 - share, share])
        updated = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        settled = np.abs(updated - posterior).max(initial=0) < 1e-9
        posterior = updated
        if settled:
            break
    return table, share, posterior


def _inputs(pattern: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    said = votes_of(pattern)
    return np.concatenate([said > 0, said < 0, shapes.reshape(len(pattern), len(SHAPE)), np.ones((len(pattern), 1))],
                          axis=1).astype(float)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton's method."""
    weight = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (p - y) + penalty * weight
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), slope)
        weight -= step
        if np.abs(step).max() < 1e-8:
            break
    return weight


@dataclass
class Model:
    """Per kind: how often labelers vote on true and false spans, and the classifier's weights."""

    tables: dict[int, np.ndarray]
    weights: dict[int, np.ndarray]

    def probabilities(self, kind: np.ndarray, pattern: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(kind))
        x = _inputs(pattern, shapes)
        for k, weight in self.weights.items():
            own = kind == k
            found[own] = 1 / (1 + np.exp(-np.clip(x[own] @ weight, -30, 30)))
        return found


def fit(scanned: DataFrame, per_kind: int = SAMPLE_PER_KIND) -> Model:
    """The model of rows with the columns of ``SCANNED``; without any span it accepts nothing."""
    spans = scanned.select(F.explode("found").alias("s")).select("s.*")
    counted: dict[int, list[tuple[int, int]]] = {}
    for row in spans.groupBy("kind", "pattern").count().collect():     # at most kinds * PATTERNS rows
        counted.setdefault(row["kind"], []).append((row["pattern"], row["count"]))
    tables, posteriors = {}, {}
    for kind, rows in counted.items():
        pattern, count = (np.array(c, np.int64) for c in zip(*sorted(rows)))
        tables[kind], _, posterior = reliabilities(pattern, count)
        posteriors[kind] = dict(zip(pattern.tolist(), posterior.tolist()))
    order = [F.xxhash64("start", "end", "pattern", "shape"), "start", "end", "pattern", F.col("shape").cast("string")]
    weights = {}
    for kind in sorted(counted):
        # at most per_kind rows
        rows = spans.where(F.col("kind") == kind).select("start", "end", "pattern", "shape").orderBy(*order).limit(
            per_kind).collect()
        pattern = np.array([r["pattern"] for r in rows], np.int64)
        x = _inputs(pattern, np.array([r["shape"] for r in rows]))
        weights[kind] = logistic(x, np.array([posteriors[kind][p] for p in pattern.tolist()]))
    return Model(tables, weights)


def accepted(spans: list[dict], probability: list[float], least: float = ACCEPTED) -> list[tuple[int, int, int]]:
    """Base spans, and candidates that are likely enough; of candidates that overlap, the likelier stays."""
    chosen = [(s["start"], s["kind"], s["end"]) for s in spans if s["base"]]
    likely = sorted(((-p, s["start"], s["kind"], s["end"]) for s, p in zip(spans, probability)
                     if not s["base"] and p >= least))
    taken: list[tuple[int, int]] = []
    for _, start, kind, end in likely:
        at = bisect.bisect_left(taken, (start,))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
            taken.insert(at, (start, end))
            chosen.append((start, kind, end))
    return sorted(chosen)


def with_spans(scanned: DataFrame, model: Model, least: float = ACCEPTED) -> DataFrame:
    """``scanned`` with ``n_added``, how many candidates are accepted, and ``spans``, instead of ``found``."""
    ship_package(scanned.sparkSession)
    kept = [f for f in scanned.schema if f.name != "found"]
    schema = T.StructType(kept + [T.StructField("n_added", T.LongType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("found").to_pylist()
            flat = [s for row in rows for s in row]
            chance = model.probabilities(
                np.array([s["kind"] for s in flat], np.int64), np.array([s["pattern"] for s in flat], np.int64),
                np.array([s["shape"] for s in flat], float)).tolist()
            spans, at = [], 0
            for row in rows:
                spans.append(accepted(row, chance[at:at + len(row)], least))
                at += len(row)
            added = [len(s) - sum(f["base"] for f in row) for s, row in zip(spans, rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(added, pa.int64()),
                                                        pa.array(map(joined, spans), pa.string())], schema.names)

    return scanned.mapInArrow(run, schema)


def personal_data(docs: DataFrame, text_col: str = "text", carried: list[str] | None = None,
                  per_kind: int = SAMPLE_PER_KIND, least: float = ACCEPTED) -> DataFrame:
    """``carried`` columns (all, if not given), counts of the base spans, their digest ``base_sha256``,
    ``n_added`` and ``spans``: all spans as ``kind:start:end`` in code points, by start and kind.

    Texts are read once, whole. A null or empty text has no span. Rows that repeat an id or a text are rows like
    others, and count as often in the reliabilities. A carried column that is called like an added one
    is replaced. Empty tables give no rows.
    """
    names = {f.name.lower() for f in SCANNED} | {"n_added", "spans"}
    held = [c for c in (docs.columns if carried is None else carried) if c.lower() not in names]
    scanned = settle_texts(with_columns_in_arrow(docs, text_col, SCANNED, scan, held), "scanned")
    return with_spans(scanned, fit(scanned, per_kind), least)
