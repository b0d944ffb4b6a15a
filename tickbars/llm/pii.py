"""Personal data: patterns, and a skip-chain conditional random field for what they miss.

Patterns find emails, ip addresses, card and phone numbers. They label the nodes of a
field over each document's words that have a digit or an at sign. Neighbouring words
share a chain potential; words with the same digits or the same address, however far
apart, share a skip potential, and so do words that only together have the digits, such as
the four of a card. Weights come from the patterns' own labels, by pseudo-likelihood on a
bounded sample of documents, in which every labelled word also stands beside a twin of
which only the label is seen: samples need hold no repeats for the skip potential to be
fitted. Loopy message passing then spreads
the patterns' labels, which stay fixed, over the document until its messages come to
rest. A repeat is also joined to the labelled words of its key directly, so that neither
its distance in the document nor the number of repeats between counts. A number that a
pattern finds in one place and not, for its spelling, in another is added there where the
fitted weights make it sure. Messages take as many rounds as a document needs to rest, at
most its words and a thousand; one that never rests costs its edges as often.

Every document is searched over its whole text; null is empty. Rows are searched one by
one, so null or repeated ids and extra columns change nothing. An empty table, or one
without digits and at signs, fits nothing and the patterns alone remain.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.tables import store
from tickbars.llm.textbytes import bytes_of

#: Fixed names, in the order that settles ties.
KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_PART = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
)
# Starting inside a run of digits matches what starting at its front does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\S+")
_TELLING = re.compile(r"[0-9@]")
#: A word of digits and marks.
_NUMBER = re.compile(r"[\W\d_]+")
#: Numbers of fewer digits repeat by chance; longer ones, or of more words, are no number
#: that the patterns know.
LEAST_DIGITS = 6
MOST_DIGITS = 19
MOST_WORDS = 10
_EDGES = "\"'`.,;:!?%*&$#|<>[]{}=_~^/\\"


@dataclass(frozen=True)
class FieldSettings:
    """The fit reads ``sample`` documents at most, those whose hashed rows come first.

    ``sure``: the marginal from which a word is personal data by the field alone.
    ``rest``: a document is done when no message of it changes by more. Where the largest
    change has not fallen for ``patience`` rounds, messages swing or still travel, and the
    document's steps are halved, down to a sixteenth.
    """

    sample: int = 2_000
    buckets: int = 4_096
    steps: int = 250
    ridge: float = 1e-3
    rest: float = 1e-3
    patience: int = 24
    damping: float = 0.3
    sure: float = 0.9


@dataclass(frozen=True)
class Weights:
    words: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) that the patterns find, in order."""
    found = []
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL_PART:
                start -= 1
            if start < at:
                done = domain.end()
                found.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    for kind, pattern, fits in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        for m in pattern.finditer(text):
            if fits(m.group()):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    digits = [int(c) for c in text if "0" <= c <= "9"]
    if not 14 <= len(digits) <= 19:
        return False
    digits[-2::-2] = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return sum(digits) % 10 == 0


def _is_phone(text: str) -> bool:
    return 10 <= sum("0" <= c <= "9" for c in text) <= 15


@dataclass
class Fields:
    """The fields of some documents as one graph."""

    row: list[int] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)
    #: From a labelled word to a repeat that has no skip edge with one of its label. The
    #: messages take the skip potential along them; weights are fitted without them.
    told: list[tuple[int, int]] = field(default_factory=list)

    def add(
        self,
        row: int,
        text: str,
        spans: list[tuple[int, int, int]],
        buckets: int,
        *,
        twins: bool = False,
    ) -> None:
        """The field of one text. ``twins``: labelled words also get a repeat of which
        nothing but its label is known, so that a fit sees what repeats are like."""
        before = None
        k = 0
        previous, place = "", -2
        begin = len(self.row)
        keyed: list[tuple[str, list[int]]] = []
        #: Neighbouring words of digits and marks, each with its digits.
        runs: list[list[tuple[int, str]]] = []
        inside: dict[int, list[int]] = {}
        for number, m in enumerate(_WORD.finditer(text)):
            word = m.group()
            if not _TELLING.search(word):
                if place == number - 1:
                    previous = ""
                continue
            core = word.strip(_EDGES) or word
            low = m.start() + word.find(core)
            high = low + len(core)
            while k < len(spans) and spans[k][2] <= low:
                k += 1
            label = 0
            node = len(self.row)
            for at in range(k, min(k + len(KINDS), len(spans))):
                if spans[at][0] < high and spans[at][2] > low:
                    label = label or spans[at][1] + 1
                    inside.setdefault(at, []).append(node)
            self.row.append(row)
            self.start.append(low)
            self.end.append(high)
            self.label.append(label)
            exact, rough = _shapes(core)
            next_to = place == number - 1
            self.features.append(
                _hashed((f"s{exact}", f"r{rough}", f"b{previous if next_to else ''}", "1"), buckets)
            )
            if next_to and before is not None:
                self.chain.append((before, node))
                self.features[before] += _hashed((f"n{rough}",), buckets)
            if _NUMBER.fullmatch(core):
                if not runs or not next_to or runs[-1][-1][0] != node - 1:
                    runs.append([])
                runs[-1].append((node, _digits(core)))
            before, place, previous = node, number, rough
            key = _skip_key(core)
            if key:
                keyed.append((key, [node]))
        for at, nodes in inside.items():
            if spans[at][1]:
                keyed.append((_digits(text[spans[at][0] : spans[at][2]]), nodes))
        keyed += _written_out(runs, {d for d, _ in keyed})
        same: dict[str, list[list[int]]] = {}
        for key, nodes in sorted(keyed, key=lambda x: x[1]):
            groups = same.setdefault(key, [])
            long = "@" in key or len(key) >= LEAST_DIGITS
            if long and (not groups or groups[-1] != nodes):
                groups.append(nodes)
        for groups in same.values():
            self._join(groups)
        for node in range(begin, len(self.row)) if twins else ():
            if self.label[node]:
                self.skip.append((node, len(self.row)))
                for values, value in (
                    (self.row, row), (self.start, 0), (self.end, 0), (self.label, self.label[node]),
                    (self.features, _hashed(("1",), buckets)),
                ):
                    values.append(value)

    def _join(self, groups: list[list[int]]) -> None:
        """Skip edges between consecutive occurrences of a key, each of one or more words,
        and told ones to those that are far from a labelled one."""
        for a, b in zip(groups[:-1], groups[1:], strict=True):
            pairs = [
                (a[min(i, len(a) - 1)], b[min(i, len(b) - 1)]) for i in range(max(len(a), len(b)))
            ]
            self.skip += [x for x in pairs if x[0] != x[1]]
        labels = [{self.label[x] for x in nodes} - {0} for nodes in groups]
        first: dict[int, int] = {}
        for nodes in groups:
            for node in nodes:
                if self.label[node]:
                    first.setdefault(self.label[node], node)
        for at, nodes in enumerate(groups if first else ()):
            if not labels[at]:
                beside = set().union(*labels[max(at - 1, 0) : at + 2])
                self.told += [
                    (x, node)
                    for label, x in first.items()
                    if label not in beside
                    for node in nodes
                ]

    def arrays(self):
        sizes = [len(x) for x in self.features]
        rows = np.repeat(np.arange(len(sizes)), sizes)
        columns = np.array([f for x in self.features for f in x], dtype=np.int64)
        chain = np.array(self.chain, dtype=np.int64).reshape(-1, 2)
        skip = np.array(self.skip, dtype=np.int64).reshape(-1, 2)
        return rows, columns, chain, skip


def _shapes(core: str) -> tuple[str, str]:
    """The word with letters as a and digits counted, and without the counts."""
    runs = [
        ("9" if m.group()[0].isdigit() else "a" if m.group()[0].isalpha() else m.group(), len(m.group()))
        for m in re.finditer(r"[0-9]+|[^\W\d_]+|.", core, re.S)
    ]
    exact = "".join(f"9{n}," if c == "9" else c for c, n in runs)
    return exact, "".join(c for c, _ in runs)


def _skip_key(core: str) -> str:
    """What words that stand for the same thing have in common."""
    if "@" in core:
        return core.lower()
    digits = _digits(core)
    return digits if len(digits) >= LEAST_DIGITS else ""


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _written_out(
    runs: list[list[tuple[int, str]]], known: set[str]
) -> list[tuple[str, list[int]]]:
    """Numbers of several words: whole runs, and parts of runs that are ``known``."""
    found = []
    for run in runs:
        if len(run) > 1:
            found.append(("".join(d for _, d in run), [node for node, _ in run]))
        for first in range(len(run) - 1):
            digits = run[first][1]
            for last in range(first + 1, min(first + MOST_WORDS, len(run))):
                digits += run[last][1]
                if len(digits) > MOST_DIGITS:
                    break
                if digits in known and last - first + 1 < len(run):
                    found.append((digits, [node for node, _ in run[first : last + 1]]))
    return found


def _hashed(names: tuple[str, ...], buckets: int) -> list[int]:
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % buckets for x in names]


def fit_field(documents: DataFrame, settings: FieldSettings = FieldSettings()) -> Weights:
    """Weights from the patterns' labels on the sample."""
    order = F.xxhash64(F.lit(23), "doc_id", "text")
    telling = documents.where(F.col("text").rlike("[0-9@]")).select("text", order.alias("order"))
    chosen = telling.select("order").distinct().orderBy("order").limit(settings.sample)
    sample = (
        telling.join(F.broadcast(chosen), "order")
        .dropDuplicates(["order"])
        .orderBy("order")
        .select("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = Fields()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                fields.add(0, text, base_spans(text), settings.buckets, twins=True)
        weights = fit_weights(fields, settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes()]) for x in (weights.words, weights.chain, weights.skip)],
            names=["words", "chain", "skip"],
        )

    fitted = store(
        sample.coalesce(1).mapInArrow(run, "words binary, chain binary, skip binary"),
        "pii-weights",
    ).first()
    if fitted is None:
        return fit_weights(Fields(), settings)
    words, chain, skip = (np.frombuffer(x).reshape(-1, LABELS) for x in fitted)
    return Weights(words, chain, skip)


def fit_weights(fields: Fields, settings: FieldSettings) -> Weights:
    """Adam on the pseudo-likelihood: each word's label given its neighbours' labels."""
    rows, columns, chain, skip = fields.arrays()
    n, width = len(fields.label), settings.buckets
    label = np.array(fields.label, dtype=np.int64)
    x = np.zeros((width + 2 * LABELS, LABELS))
    mean, square = np.zeros_like(x), np.zeros_like(x)
    one = np.eye(LABELS)[label] if n else np.zeros((0, LABELS))
    for step in range(1, settings.steps + 1):
        if not n:
            break
        words, forth, pair = x[:width], x[width : width + LABELS], x[width + LABELS :]
        score = np.stack(
            [np.bincount(rows, words[columns, k], minlength=n) for k in range(LABELS)], axis=1
        )
        both = (pair + pair.T) / 2
        np.add.at(score, chain[:, 1], forth[label[chain[:, 0]]])
        np.add.at(score, chain[:, 0], forth.T[label[chain[:, 1]]])
        np.add.at(score, skip[:, 1], both[label[skip[:, 0]]])
        np.add.at(score, skip[:, 0], both[label[skip[:, 1]]])
        score -= score.max(axis=1, keepdims=True)
        p = np.exp(score)
        error = p / p.sum(axis=1, keepdims=True) - one
        gradient = np.zeros_like(x)
        for k in range(LABELS):
            gradient[:width, k] = np.bincount(columns, error[rows, k], minlength=width)
        np.add.at(gradient[width : width + LABELS], label[chain[:, 0]], error[chain[:, 1]])
        np.add.at(gradient[width : width + LABELS].T, label[chain[:, 1]], error[chain[:, 0]])
        np.add.at(gradient[width + LABELS :], label[skip[:, 0]], error[skip[:, 1]])
        np.add.at(gradient[width + LABELS :], label[skip[:, 1]], error[skip[:, 0]])
        gradient[width + LABELS :] = (
            gradient[width + LABELS :] + gradient[width + LABELS :].T
        ) / 2
        gradient = gradient / n + settings.ridge * x
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        x = x - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    pair = x[width + LABELS :]
    return Weights(x[:width], x[width : width + LABELS], (pair + pair.T) / 2)


def marginals(fields: Fields, weights: Weights, settings: FieldSettings) -> np.ndarray:
    """Loopy sum-product over all documents' graphs at once; the patterns' labels are fixed.

    Each document goes on until its own messages rest, whatever documents are beside it.
    One whose messages swing for ever stops after as many rounds as it has words and a
    thousand: by then every message has passed the whole document.
    """
    rows, columns, chain, skip = fields.arrays()
    told = np.array(fields.told, dtype=np.int64).reshape(-1, 2)
    skip = np.concatenate([skip, told])
    n = len(fields.label)
    own = np.stack(
        [np.bincount(rows, weights.words[columns, k], minlength=n) for k in range(LABELS)],
        axis=1,
    )
    label = np.array(fields.label, dtype=np.int64)
    own[label > 0] = -40.0
    own[label > 0, label[label > 0]] = 0.0
    # Each edge carries a message each way; potential[e][from, to].
    start = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
    end = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
    kind = np.repeat([0, 1, 2, 2], [len(chain), len(chain), len(skip), len(skip)])
    back = np.concatenate(
        [
            np.arange(len(chain)) + len(chain),
            np.arange(len(chain)),
            np.arange(len(skip)) + 2 * len(chain) + len(skip),
            np.arange(len(skip)) + 2 * len(chain),
        ]
    )
    potential = np.stack([weights.chain, weights.chain.T, weights.skip])[kind]
    message = np.zeros((len(start), LABELS))
    belief = own.copy()
    row = np.array(fields.row, dtype=np.int64)
    size = np.bincount(row)
    step = np.full(len(size), 1 - settings.damping)
    least, stale = np.full(len(size), np.inf), np.zeros(len(size), dtype=np.int64)
    live, done = np.arange(len(start)), 0
    while len(live):
        sent = belief[start[live]] - message[back[live]]
        new = _log_sum(sent[:, :, None] + potential[live], axis=1)
        new -= _log_sum(new, axis=1)[:, None]
        new -= message[live]
        of = row[start[live]]
        change = np.zeros(len(size))
        np.maximum.at(change, of, np.abs(new).max(axis=1))
        message[live] += step[of, None] * new
        belief[end[live]] = own[end[live]]
        np.add.at(belief, end[live], message[live])
        done += 1
        fell = change < 0.99 * least
        least = np.minimum(least, change)
        stale = np.where(fell, 0, stale + 1)
        swings = stale >= settings.patience
        step = np.where(swings, np.maximum(step / 2, (1 - settings.damping) / 16), step)
        stale[swings] = 0
        going = (change > settings.rest) & (done < size + 1_000)
        if not going[of].all():
            live = live[going[of]]
    belief -= belief.max(axis=1, keepdims=True) if n else 0
    p = np.exp(belief)
    return p / p.sum(axis=1, keepdims=True)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(x - most).sum(axis=axis))


def added_spans(fields: Fields, p: np.ndarray, sure: float) -> dict[int, list]:
    """Row: spans of words that the field alone calls personal data; runs are one span."""
    best = p[:, 1:].argmax(axis=1) if len(p) else np.zeros(0, dtype=np.int64)
    linked = set(fields.chain)
    spans: dict[int, list] = {}
    for node, label in enumerate(fields.label):
        if label or p[node, best[node] + 1] < sure:
            continue
        own = spans.setdefault(fields.row[node], [])
        kind = int(best[node])
        if own and own[-1][3] == node - 1 and own[-1][1] == kind and (node - 1, node) in linked:
            own[-1] = (own[-1][0], kind, fields.end[node], node)
        else:
            own.append((fields.start[node], kind, fields.end[node], node))
    return {row: [x[:3] for x in found] for row, found in spans.items()}


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def find_personal_data(
    documents: DataFrame, weights: Weights, settings: FieldSettings = FieldSettings()
) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    kind = documents.schema["doc_id"].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 2_000):
                batch = whole.slice(low, 2_000)
                base, extra = _search(batch.column("text"), shared.value, settings)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        *(
                            pa.array([sum(s[1] == k for s in x) for x in base], pa.int64())
                            for k in range(len(KINDS))
                        ),
                        pa.array([hashlib.sha256(_told(x).encode()).hexdigest() for x in base]),
                        pa.array([_told(x + extra.get(i, [])) for i, x in enumerate(base)]),
                    ],
                    names=["doc_id", *counts, "base_sha256", "spans"],
                )

    return documents.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, {', '.join(c + ' long' for c in counts)}, "
        "base_sha256 string, spans string",
    )


def _search(
    column: pa.Array, weights: Weights, settings: FieldSettings
) -> tuple[list[list], dict[int, list]]:
    """Each row's pattern spans, and by row what the field adds."""
    data, bounds = bytes_of(column)
    part = data[bounds[0] : bounds[-1]]
    telling = np.flatnonzero(((part >= 0x30) & (part <= 0x39)) | (part == 0x40)) + bounds[0]
    has = np.diff(np.searchsorted(telling, bounds)) > 0
    base: list[list] = [[] for _ in range(len(column))]
    fields = Fields()
    for row in np.flatnonzero(has).tolist():
        text = column[row].as_py()
        base[row] = base_spans(text)
        fields.add(row, text, base[row], settings.buckets)
    if not fields.label:
        return base, {}
    return base, added_spans(fields, marginals(fields, weights, settings), settings.sure)
