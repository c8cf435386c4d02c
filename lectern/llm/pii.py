"""Personal data by weak supervision.

Candidates are spans of ten kinds. The four base kinds (email, ip, card, phone)
have exact rules and always stand. The others are looser forms: a phone number
without a plus, an identity number, an account number, a spelled-out email. A
set of labelers votes on each candidate (yes, no, or abstains):

* regex labelers: does the strict rule hold, is the writing canonical;
* gazetteer labelers: is the domain's ending, the number's country, the card's
  first digits, the account's country or the address's range a known one;
* context labelers: is a word nearby that announces such data, or one that
  announces another number; does the span stand free.

Equal votes are counted over all documents in Spark. On that table, whose size
is bounded by the number of labelers, expectation-maximisation estimates how
reliable each labeler is and how likely each pattern is personal data; the
posteriors train the final span classifier (logistic regression over votes,
kinds and shapes). A looser span is reported where the classifier is sure
enough and it overlaps no base span.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import prepare, text_slices

BASE_KINDS = ("email", "ip", "card", "phone")
LOOSE_KINDS = ("account", "email_spelled", "id_number", "phone_local")
KINDS = BASE_KINDS + LOOSE_KINDS
SURE = 0.9                 # a looser span is reported from this probability on
CONTEXT = 40               # characters around a span that context labelers read

# The gazetteers.
ENDINGS = frozenset("com net org edu gov info io co uk de fr es it nl eu ch at be pl us ca au jp br".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
                 "47", "48", "49", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82",
                 "84", "86", "90", "91", "92", "351", "352", "353", "358", "420", "421")
CARD_STARTS = ("4", "34", "37", "51", "52", "53", "54", "55", "6011", "62", "65", "2221", "2720")
ACCOUNT_COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
ANNOUNCE = re.compile(r"\b(?:e-?mail|mail|contact|kontakt|contacto|phone|tel|telefon|téléphone|teléfono|mobile|handy|"
                      r"call|fax|ip|address|adresse|host|card|karte|carte|tarjeta|visa|iban|konto|account|ssn|"
                      r"social security|passport|steuer)\b", re.I)
OTHER_NUMBER = re.compile(r"\b(?:isbn|issn|doi|version|invoice|rechnung|facture|factura|order|page|chapter|vol|"
                          r"figure|table|total|price|sku|part)\b", re.I)

_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOOSE = {
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])"),
    "id_number": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "phone_local": re.compile(r"(?<![0-9+)(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"),
}
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]{1,64}"
                      r"(?: ?[(\[] ?dot ?[)\]] ?[A-Za-z0-9-]{1,64})+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    """Leftmost non-overlapping addresses, found from their @: one step per
    character at most, however long a run of letters is."""
    free = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def strict(kind: str, span: str) -> bool:
    """The validity rule of a base kind."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in span.split("."))
    digits = _NOT_DIGIT.sub("", span)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base kinds, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        out += [(k, m.start(), m.end()) for m in pattern.finditer(text) if strict(KINDS[k], m.group())]
    return out


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the looser kinds that overlap no base span."""
    taken = sorted((a, b) for _, a, b in base)
    begins = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else []
    out = []
    for k, kind in enumerate(KINDS):
        if kind in BASE_KINDS:
            continue
        found = _spelled(text) if kind == "email_spelled" else (m.span() for m in _LOOSE[kind].finditer(text))
        for a, b in found:
            i = bisect_right(begins, b - 1)
            if not i or reach[i - 1] <= a:
                out.append((k, a, b))
    return out


def _spelled(text: str):
    return (m.span() for m in _SPELLED.finditer(text)) if "at" in text and ("(" in text or "[" in text) else ()


# ---------------------------------------------------------------- labelers: 1 yes, -1 no, 0 abstains

def _vote_regex(kind: str, span: str, left: str, right: str) -> int:
    if kind in BASE_KINDS:
        return 1 if strict(kind, span) else -1
    if kind == "id_number":
        a, b, c = span.split("-")
        return -1 if a in ("000", "666") or a[0] == "9" or b == "00" or c == "0000" else 1
    if kind == "account":
        plain = span.replace(" ", "")
        turned = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        return 1 if int(turned) % 97 == 1 else -1
    return 0


def _vote_writing(kind: str, span: str, left: str, right: str) -> int:
    if kind in ("phone", "phone_local"):
        digits = _NOT_DIGIT.sub("", span)
        area = digits[-10:-7]
        return -1 if len(set(digits)) < 3 or (kind == "phone_local" and area[:1] in ("0", "1")) else 1
    if kind == "card":
        return 1 if len({c for c in span if not c.isdigit()}) <= 1 else -1
    if kind == "ip":
        return -1 if any(len(p) > 1 and p[0] == "0" for p in span.split(".")) else 1
    return 0


def _vote_gazetteer(kind: str, span: str, left: str, right: str) -> int:
    if kind in ("email", "email_spelled"):
        return 1 if re.split(r"[^A-Za-z0-9-]+", span.strip(")]( ["))[-1].lower() in ENDINGS else -1
    digits = _NOT_DIGIT.sub("", span)
    if kind == "phone":
        return 1 if digits.startswith(CALLING_CODES) else -1
    if kind == "card":
        return 1 if digits.startswith(CARD_STARTS) else 0
    if kind == "ip":
        return -1 if span.startswith(("0.", "127.", "255.")) else 1
    if kind == "account":
        return 1 if span[:2] in ACCOUNT_COUNTRIES else -1
    return 0


def _vote_announced(kind: str, span: str, left: str, right: str) -> int:
    return 1 if ANNOUNCE.search(left) else 0


def _vote_other(kind: str, span: str, left: str, right: str) -> int:
    return -1 if OTHER_NUMBER.search(left) else 0


def _vote_free(kind: str, span: str, left: str, right: str) -> int:
    glued = (left[-1:].isalnum() or left[-1:] in tuple("$#/=_")) or (right[:1].isalnum() or right[:1] in tuple("%/=_"))
    return -1 if glued else 1


LABELERS = (_vote_regex, _vote_writing, _vote_gazetteer, _vote_announced, _vote_other, _vote_free)


def votes(text: str, kind: int, start: int, end: int) -> tuple[int, ...]:
    span, left, right = text[start:end], text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    return tuple(f(KINDS[kind], span, left, right) for f in LABELERS)


def _code(kind: int, v: tuple[int, ...]) -> int:
    """Kind and votes as one number: at most len(KINDS) * 3 ** len(LABELERS)."""
    for x in v:
        kind = kind * 3 + x + 1
    return kind


def _uncode(code: int) -> tuple[int, tuple[int, ...]]:
    out = []
    for _ in LABELERS:
        out.append(code % 3 - 1)
        code //= 3
    return code, tuple(reversed(out))


# ---------------------------------------------------------------- aggregation and classifier

@dataclass
class SpanModel:
    reliability: np.ndarray    # per labeler: P(yes | personal), P(no | not)
    prior: np.ndarray          # per kind
    weights: np.ndarray        # logistic regression

    def probability(self, kind: int, v: tuple[int, ...]) -> float:
        return float(1 / (1 + np.exp(-(_features(kind, v) @ self.weights))))


def _features(kind: int, v: tuple[int, ...]) -> np.ndarray:
    x = np.zeros(1 + 2 * len(LABELERS) + len(KINDS))
    x[0] = 1.0
    for i, vote in enumerate(v):
        x[1 + 2 * i] = vote > 0
        x[2 + 2 * i] = vote < 0
    x[1 + 2 * len(LABELERS) + kind] = 1.0
    return x


def expectation_maximisation(patterns: dict[int, int], rounds: int = 50) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    """Reliabilities, priors and the posterior of each pattern (code -> count).

    Two classes, labelers independent given the class; abstaining tells
    nothing. Beta priors of four imagined votes at 0.75 keep labelers that never vote, and a
    corpus without looser spans, well defined.
    """
    codes = sorted(patterns)
    n = np.array([patterns[c] for c in codes], dtype=np.float64)
    kinds = np.array([_uncode(c)[0] for c in codes], dtype=np.int64)
    v = np.array([_uncode(c)[1] for c in codes], dtype=np.int64).reshape(len(codes), len(LABELERS))
    yes, no = v > 0, v < 0
    good = np.full((len(LABELERS), 2), 0.75)
    prior = np.full(len(KINDS), 0.5)
    post = np.zeros(len(codes))
    for _ in range(rounds):
        pos = np.log(prior[kinds]) + yes @ np.log(good[:, 0]) + no @ np.log(1 - good[:, 0])
        neg = np.log(1 - prior[kinds]) + no @ np.log(good[:, 1]) + yes @ np.log(1 - good[:, 1])
        post = 1 / (1 + np.exp(np.clip(neg - pos, -500, 500)))
        a, b = n * post, n * (1 - post)
        good[:, 0] = (a @ yes + 3) / (a @ (yes | no) + 4)
        good[:, 1] = (b @ no + 3) / (b @ (yes | no) + 4)
        good = np.clip(good, 0.55, 0.99)                # a labeler is better than chance
        prior = (np.bincount(kinds, a, len(KINDS)) + 1) / (np.bincount(kinds, n, len(KINDS)) + 2)
        prior = np.clip(prior, 0.01, 0.99)
    return good, prior, dict(zip(codes, post.tolist()))


def train(patterns: dict[int, int]) -> SpanModel:
    good, prior, post = expectation_maximisation(patterns)
    codes = sorted(patterns)
    w = np.zeros(1 + 2 * len(LABELERS) + len(KINDS))
    x = np.array([_features(*_uncode(c)) for c in codes]).reshape(len(codes), len(w))
    y = np.array([post[c] for c in codes])
    n = np.array([patterns[c] for c in codes], dtype=np.float64)
    for _ in range(25):                                  # Newton steps, ridge of 1
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
    return SpanModel(good, prior, w)


# ---------------------------------------------------------------- Spark

_MAY = np.zeros(256, dtype=bool)
_MAY[[*range(48, 58), 64, 40, 91]] = True       # a digit, @, ( or [: nothing else begins a candidate


def _texts(batches, text_col: str):
    """(batch, first row, per text: the text where it may hold a candidate, else None)."""
    for batch in batches:
        for lo, hi, buf, off in text_slices(batch, text_col):
            marks = np.flatnonzero(_MAY[buf])
            has = np.diff(np.searchsorted(marks, off)) > 0
            yield batch, lo, [buf[off[i]:off[i + 1]].tobytes().decode() if has[i] else None for i in range(hi - lo)]


def _count_patterns(text_col: str):
    def run(batches):
        seen: dict[int, int] = {}
        for _, _, texts in _texts(batches, text_col):
            for text in filter(None, texts):
                base = base_spans(text)
                for k, a, b in base + loose_spans(text, base):
                    code = _code(k, votes(text, k, a, b))
                    seen[code] = seen.get(code, 0) + 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                             ["code", "n"])
    return run


def _spans(id_col: str, text_col: str, model_bc, sure: float):
    def run(batches):
        model = model_bc.value
        for batch, lo, texts in _texts(batches, text_col):
            bounds, kind, start, end, score, base_flag = [0], [], [], [], [], []
            for text in texts:
                if text is not None:
                    base = base_spans(text)
                    found = [(k, a, b, model.probability(k, votes(text, k, a, b)), True) for k, a, b in base]
                    for k, a, b in loose_spans(text, base):
                        p = model.probability(k, votes(text, k, a, b))
                        if p >= sure:
                            found.append((k, a, b, p, False))
                    for k, a, b, p, is_base in found:
                        kind.append(KINDS[k])
                        start.append(a)
                        end.append(b)
                        score.append(p)
                        base_flag.append(is_base)
                bounds.append(len(kind))
            spans = pa.StructArray.from_arrays(
                [pa.array(kind, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32()),
                 pa.array(score, pa.float64()), pa.array(base_flag, pa.bool_())],
                ["kind", "start", "end", "score", "base"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col)[lo:lo + len(texts)], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)],
                [id_col, "spans"])
    return run


def fit(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Count vote patterns over all documents and train on the table."""
    prepare(docs.sparkSession)
    rows = (docs.select(text_col).mapInArrow(_count_patterns(text_col), "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).collect())
    return train({r["code"]: r["n"] for r in rows})


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sure: float = SURE) -> DataFrame:
    """(id, spans) per row: spans by kind (in the order of KINDS), then start.

    A span has kind, start, end (code points), the classifier's score and
    whether it is a base span. Null and empty texts have none. Repeated rows get
    equal spans; other columns are ignored; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, text_col))
    schema = (f"{id_col} {dict(docs.dtypes)[id_col]}, "
              "spans array<struct<kind:string,start:int,end:int,score:double,base:boolean>>")
    return docs.select(id_col, text_col).mapInArrow(_spans(id_col, text_col, model, sure), schema)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of
    overlapping spans the one that begins first is replaced."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    done = F.aggregate(
        ordered, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda s, x: F.when(x["start"] < s["at"], s).otherwise(F.struct(
            F.concat(s["out"], F.substr(text, s["at"] + 1, x["start"] - s["at"]), F.lit("<"), x["kind"], F.lit(">")).alias("out"),
            x["end"].alias("at"))))
    return F.concat(done["out"], F.substr(text, done["at"] + 1))
