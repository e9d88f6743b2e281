"""Personal data: patterns confirm entities, a skip-chain conditional random field carries them to alike tokens.

Patterns find e-mail addresses, IP addresses, card and phone numbers; these spans always stay. The field's variables
are the tokens with a digit or an at sign, with the labels none, email, ip, card and phone. Tokens in a confirmed span are
observed. Its potentials are: of a token, how often its shape is of a kind, times the chance that the patterns miss
an entity; of neighbours, how often labels follow each other; of distant tokens that are equal or similar (the same
digits, the same mailbox), how often such tokens agree. All alike tokens of a document share one hub variable, so a
token repeated n times costs n messages and not n * n. Loopy message passing runs until beliefs settle; tokens whose
belief in a kind reaches ``SURE`` become spans, also in texts without a confirmed entity. The field is left out only
where the largest messages that a document's tokens could get provably leave all of them below ``SURE``.

The potentials come from counts over all documents, in tables of fixed size, so what the driver and every task hold does
not grow with them. Shapes that occur in confirmed spans are kept with all their counts in ``SHAPES`` places by hash; of
several in one place the one confirmed most often stays. Of the others only the number decides, and only up to
``OFTEN``: ``NEVER`` bytes hold the numbers by hash, and ``SHAPES`` places those found so often. The tables know which
places more than one shape asked for. Documents with a shape whose counts they therefore do not tell are joined with
the counts of these shapes, so every token is judged by its own shape's counts, whatever the number of shapes.

Defined results: null text is empty and has no spans; repeated rows are treated alike; an empty table gives no rows; any
column but the id and the text passes through ``redacted`` unread, ``n_chars`` is set to the new length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

from ..functions.materialize import checkpointed, stored
from .words import chunks

KINDS = ("email", "ip", "card", "phone")
MISSED = 0.02
SURE = 0.9
ROUNDS = 30
DAMPING = 0.3
LIMIT = 6.0
AGREEMENT = 400.0  # before any count: how many alike tokens agree for one that does not
RAREST = 1e-3  # the least share of a kind among the tokens of a shape
SHAPES = 1 << 16
NEVER = 1 << 20
OFTEN = 100  # from this number on a shape never confirmed has shares under ``RAREST``

MAILBOX = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")
MARKED = re.compile(r"[0-9@]\S*")

Span = tuple[str, int, int]
SLOTS = tuple(f"n{i}" for i in range(len(KINDS) + 1))


def emails(text: str) -> list[Span]:
    """Leftmost mailbox runs before each at sign; found from the at signs, so long runs without one cost nothing."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in MAILBOX:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Confirmed spans by start, then kind."""
    if not ANY.search(text):
        return []
    out = emails(text)
    for m in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = digits_of(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(digits_of(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def marked_tokens(text: str) -> list[tuple[int, int]]:
    """(start, end) of the whitespace-separated tokens that hold a digit or an at sign."""
    out, free = [], 0
    for m in MARKED.finditer(text):
        start = m.start()
        while start > free and not text[start - 1].isspace():
            start -= 1
        out.append((start, m.end()))
        free = m.end()
    return out


def shape(token: str) -> str:
    """Digits as 9, letters as a, at most 40 characters."""
    return "".join("9" if "0" <= c <= "9" else "a" if c.isalpha() else c for c in token[:40]).strip(".,;:!?\"'")


def hash_of(key: str) -> np.int64:
    """What Spark's ``xxhash64`` gives for ``key``."""
    import xxhash
    return np.uint64(xxhash.xxh64_intdigest(key.encode(), 42)).astype(np.int64)


def alike_keys(token: str) -> list[str]:
    """What equal and similar tokens have in common."""
    plain = token.strip(".,;:!?\"'()<>[]").lower()
    keys = ["=" + plain]
    digits = digits_of(plain)
    if len(digits) >= 7:
        keys.append("#" + digits[-7:])
    if "@" in plain and len(plain.partition("@")[0]) > 2:
        keys.append("@" + plain.partition("@")[0])
    return keys


def observed(tokens: list[tuple[int, int]], spans: list[Span]) -> np.ndarray:
    """Per token 1 + the kind of a confirmed span that overlaps it, or 0."""
    out = np.zeros(len(tokens), np.int64)
    starts = np.array([t[0] for t in tokens])
    for kind, a, b in reversed(spans):
        i = max(0, int(np.searchsorted(starts, a, side="right")) - 1)
        while i < len(tokens) and tokens[i][0] < b:
            if tokens[i][1] > a:
                out[i] = 1 + KINDS.index(kind)
            i += 1
    return out


class Field:
    """Potentials from counts, and message passing over one document."""

    def __init__(self, counts: Counter, shapes: dict[int, list[int]] | None = None, never: np.ndarray | None = None):
        """From ``counts``; ``shapes`` has the label counts of more shapes by hash, ``never`` by the hash's remainder the
        numbers of shapes that are in no confirmed span."""
        n = len(KINDS) + 1
        self.never = never if never is not None else np.zeros(1, np.uint8)
        self.often: frozenset[int] = frozenset()  # hashes of shapes in no confirmed span, found ``OFTEN`` or more times
        self.lost, self.mixed = np.zeros(1, bool), np.zeros(1, bool)  # places that several shapes asked for
        self.totals: DataFrame | None = None  # the counts of all shapes; stays on the driver
        self.shapes: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(n))
        for code, labels in (shapes or {}).items():
            self.shapes[code] += labels
        follows, agree = np.ones((n, n)), [1.0, AGREEMENT]
        for (what, key, a, b), times in counts.items():
            if what == "shape":
                self.shapes[hash_of(key)][a] += times
            elif what == "next":
                follows[a, b] += times
            else:
                agree[a] += times
        self.shapes = dict(self.shapes)
        joint = follows / follows.sum()
        self.next = np.clip(np.log(joint / np.outer(joint.sum(1), joint.sum(0))), -LIMIT, LIMIT)
        self.alike = min(LIMIT, max(0.0, math.log(agree[1] / agree[0])))

    def __getstate__(self) -> dict:
        return {**self.__dict__, "totals": None}

    def doubtful(self, text: str) -> list[str]:
        """The shapes in ``text`` whose counts the tables do not tell."""
        out = set()
        for key in {shape(text[a:b]) for a, b in marked_tokens(text)}:
            code = hash_of(key)
            if code not in self.shapes and code not in self.often and (
                    self.lost[code % len(self.lost)] or self.mixed[code % len(self.mixed)]):
                out.add(key)
        return sorted(out)

    def seen(self, key: str, exact: dict[str, list[int]] | None = None) -> np.ndarray | None:
        """The label counts of a shape, None if it stands nowhere; ``exact`` has those the tables do not tell."""
        if exact and key in exact:
            return np.array(exact[key], float)
        code = hash_of(key)
        if code in self.shapes:
            return self.shapes[code]
        if code in self.often:
            return np.array([OFTEN, *[0] * len(KINDS)], float)
        number = int(self.never[code % len(self.never)])
        return np.array([number, *[0] * len(KINDS)], float) if number else None

    def unary(self, token: str, exact: dict[str, list[int]] | None = None) -> np.ndarray:
        """Log potential of a token outside the confirmed spans."""
        seen = self.seen(shape(token), exact)
        share = (seen + 0.1) / (seen + 0.1).sum() if seen is not None else np.full(len(KINDS) + 1, 0.02)
        out = np.log(np.maximum(share, RAREST) * MISSED)
        out[0] = np.log(1 - MISSED)
        return out

    def labels(self, text: str, tokens: list[tuple[int, int]], known: np.ndarray,
               exact: dict[str, list[int]] | None = None) -> np.ndarray:
        """The believed label of each token, 0 where none is sure."""
        n, k = len(tokens), len(KINDS) + 1
        words = [text[a:b] for a, b in tokens]
        own = np.zeros((n, k))
        for i, w in enumerate(words):
            own[i] = np.where(np.arange(k) == known[i], 0.0, -50.0) if known[i] else self.unary(w, exact)
        groups = defaultdict(list)
        for i, w in enumerate(words):
            for key in alike_keys(w):
                groups[key].append(i)
        links = [(i, h) for h, members in enumerate(g for g in groups.values() if len(g) > 1) for i in members]
        pairs = [i for i in range(n - 1) if tokens[i + 1][0] - tokens[i][1] <= 2 and not text[tokens[i][1]:tokens[i + 1][0]].strip()]
        li = np.array([x[0] for x in links], int)
        lh = np.array([x[1] for x in links], int)
        n_hubs = int(lh.max()) + 1 if len(lh) else 0
        up, down = np.zeros((len(li), k)), np.zeros((len(li), k))  # token to hub, hub to token
        right, left = np.zeros((len(pairs), k)), np.zeros((len(pairs), k))
        p = np.array(pairs, int)
        same = np.eye(k) * self.alike
        most = own - own[:, :1]  # no message favours a kind over none by more than its potential does
        np.add.at(most, li, self.alike)
        np.add.at(most, p + 1, np.maximum(0.0, (self.next - self.next[:, :1]).max(axis=0)))
        np.add.at(most, p, np.maximum(0.0, (self.next - self.next[:1]).max(axis=1)))
        if most[known == 0, 1:].max() < math.log(SURE / (1 - SURE)) - 1e-6:
            return np.zeros(n, np.int64)

        def through(belief: np.ndarray, potential: np.ndarray) -> np.ndarray:
            x = belief[:, :, None] + potential[None]
            top = x.max(axis=1, keepdims=True)
            out = np.log(np.exp(x - top).sum(axis=1)) + top[:, 0]
            return out - out.max(axis=1, keepdims=True)
        belief = own
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, li, down)
            np.add.at(belief, p + 1, right)
            np.add.at(belief, p, left)
            hub = np.zeros((n_hubs, k))
            np.add.at(hub, lh, up)
            fresh = (through(belief[li] - down, same), through(hub[lh] - up, same) if n_hubs else down,
                     through(belief[p] - left, self.next), through(belief[p + 1] - right, self.next.T))
            change = max((float(np.abs(a - b).max()) for a, b in zip((up, down, right, left), fresh) if a.size), default=0.0)
            up, down, right, left = (DAMPING * a + (1 - DAMPING) * b for a, b in zip((up, down, right, left), fresh))
            if change < 1e-3:
                break
        chance = np.exp(belief - belief.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        return np.where((best > 0) & (chance.max(axis=1) >= SURE), best, 0)

    def spans(self, text: str, exact: dict[str, list[int]] | None = None) -> tuple[list[Span], list[Span]]:
        """Confirmed spans, and all spans with what the field adds."""
        base = base_spans(text)
        tokens = marked_tokens(text) if ANY.search(text) else []
        known = observed(tokens, base)
        if known.all():
            return base, base
        found = self.labels(text, tokens, known, exact)
        added: list[list] = []
        for i, (a, b) in enumerate(tokens):
            if not found[i] or known[i]:
                continue
            kind = KINDS[found[i] - 1]
            if added and added[-1][0] == kind and added[-1][3] == i - 1 and not text[added[-1][2]:a].strip():
                added[-1][2:] = [b, i]
            else:
                added.append([kind, a, b, i])
        out = list(base)
        for kind, a, b, _ in added:
            inner = text[a:b].strip(".,;:!?\"'")
            start = text.index(inner, a) if inner else a
            out.append((kind, start, start + len(inner)))
        return base, sorted(set(out), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def statistics(text: str) -> Counter:
    """What one document contributes to the potentials."""
    out: Counter = Counter()
    tokens = marked_tokens(text)
    if not tokens:
        return out
    known = observed(tokens, base_spans(text))
    groups = defaultdict(list)
    for i, (a, b) in enumerate(tokens):
        out["shape", shape(text[a:b]), int(known[i]), 0] += 1
        if i and not text[tokens[i - 1][1]:a].strip():
            out["next", "", int(known[i - 1]), int(known[i])] += 1
        for key in alike_keys(text[a:b]):
            groups[key].append(int(known[i]))
    for labels in groups.values():  # neighbours in text order stand for the group
        for a, b in zip(labels, labels[1:]):
            if bool(a) == bool(b):  # of a confirmed and another token it isn't known whether they agree
                out["alike", "", int(a == b), 0] += 1
    return out


def fit(docs: DataFrame) -> Field:
    """A field from all of ``docs`` (doc_id, text)."""
    slots = SLOTS

    def count(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                total: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0] * len(slots))
                for text in part.column("text").to_pylist():
                    for (what, key, a, b), times in statistics(text or "").items():
                        total[(what, str(a)) if what == "next" else (what, key)][b if what == "next" else a] += times
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()),
                     *(pa.array([v[i] for v in total.values()], pa.int64()) for i in range(len(slots)))], ["what", "key", *slots])
    totals = checkpointed(docs.select("text").mapInArrow(count, f"what string, key string, {', '.join(f'{c} long' for c in slots)}")
                          .groupBy("what", "key").agg(*(F.sum(c).alias(c) for c in slots)))
    counts: Counter = Counter()
    for r in totals.where("what <> 'shape'").collect():  # a row per label and one for alike tokens
        for i, c in enumerate(slots):
            if r[c]:
                counts[("next", "", int(r["key"]), i) if r["what"] == "next" else (r["what"], r["key"], i, 0)] = r[c]
    code, confirmed = F.xxhash64("key"), sum(F.col(c) for c in slots[1:])
    shapes = totals.where("what = 'shape'").select(code.alias("code"), confirmed.alias("confirmed"), *slots)
    kept = shapes.where("confirmed > 0").groupBy(F.pmod("code", F.lit(SHAPES)).alias("place")).agg(
        F.max_by(F.struct("code", *slots), F.struct("confirmed", "code")).alias("most"),
        (F.count(F.lit(1)) > 1).alias("lost")).collect()  # at most SHAPES rows
    others = shapes.where("confirmed = 0").groupBy(F.pmod("code", F.lit(NEVER)).alias("place")).agg(
        F.least(F.sum("n0"), F.lit(OFTEN)).cast("int").alias("n"), (F.count(F.lit(1)) > 1).alias("mixed")).toArrow()  # at most NEVER rows
    often = shapes.where((F.col("confirmed") == 0) & (F.col("n0") >= OFTEN)).groupBy(F.pmod("code", F.lit(SHAPES))).agg(
        F.max_by("code", F.struct("n0", "code")).alias("code")).collect()  # at most SHAPES rows
    never = np.zeros(NEVER, np.uint8)
    places = others["place"].to_numpy()
    never[places] = others["n"].to_numpy()
    field = Field(counts, {r["most"]["code"]: [r["most"][c] for c in slots] for r in kept}, never)
    field.lost, field.mixed = np.zeros(SHAPES, bool), np.zeros(NEVER, bool)
    field.lost[[r["place"] for r in kept if r["lost"]]] = True
    field.mixed[places[others["mixed"].to_numpy()]] = True
    field.often = frozenset(r["code"] for r in often)
    field.totals = totals.where("what = 'shape'").select("key", *slots)
    return field


def _over(docs: DataFrame, field: Field, build: Callable[[pa.RecordBatch, list[tuple[list[Span], list[Span]]]], pa.RecordBatch],
          schema: str | T.StructType) -> DataFrame:
    """What ``build`` makes of slices of ``docs`` and their spans, under the columns of ``schema``.

    Documents of which the tables tell everything are done where they are read. The others are stored, joined with the
    counts of the shapes in doubt, and done after them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    crowded = bool(field.lost.any() or field.mixed.any())

    def told(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                if crowded:
                    part = part.filter(pa.array([not shared.value.doubtful(t or "") for t in part.column("text").to_pylist()], pa.bool_()))
                yield build(part, [shared.value.spans(t or "") for t in part.column("text").to_pylist()])
    out = docs.mapInArrow(told, schema)
    if not crowded:
        return out

    def doubtful(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                keys = pa.array([shared.value.doubtful(t or "") for t in part.column("text").to_pylist()], pa.list_(pa.string()))
                part = part.append_column("_keys", keys)
                yield part.filter(pa.array([bool(k) for k in keys.to_pylist()], pa.bool_()))
    kind = T.StructType([*docs.schema.fields, T.StructField("_keys", T.ArrayType(T.StringType()))])
    rows = stored(docs.mapInArrow(doubtful, kind).withColumn("_row", F.monotonically_increasing_id()), "doubtful")
    counts = rows.select("_row", F.explode("_keys").alias("key")).join(field.totals, "key").groupBy("_row").agg(
        F.collect_list(F.struct("key", F.array(*SLOTS).alias("n"))).alias("_counts"))  # a row per shape of one document

    def judged(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                exact = [{c["key"]: c["n"] for c in r} for r in part.column("_counts").to_pylist()]
                texts = part.column("text").to_pylist()
                yield build(part.select(docs_columns), [shared.value.spans(t or "", e) for t, e in zip(texts, exact)])
    docs_columns = docs.columns
    return out.unionByName(rows.drop("_keys").join(counts, "_row").drop("_row").mapInArrow(judged, schema))


def found(docs: DataFrame, field: Field) -> DataFrame:
    """Numbers of confirmed spans per kind, their digest, and all spans, per document."""
    def build(part: pa.RecordBatch, both: list[tuple[list[Span], list[Span]]]) -> pa.RecordBatch:
        counts = [Counter(s[0] for s in base) for base, _ in both]
        return pa.RecordBatch.from_arrays([
            part.column("doc_id"), *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS),
            pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in both], pa.string()),
            pa.array([joined(spans) for _, spans in both], pa.string())],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _over(docs.select("doc_id", "text"), field, build,
                 f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string")


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` following it; other columns as they are."""
    def build(part: pa.RecordBatch, both: list[tuple[list[Span], list[Span]]]) -> pa.RecordBatch:
        texts = [None if t is None else redact(t, spans) for t, (_, spans) in zip(part.column("text").to_pylist(), both)]
        at = part.schema.get_field_index("text")
        part = part.set_column(at, "text", pa.array(texts, part.schema.field("text").type))
        if "n_chars" in part.schema.names:
            at = part.schema.get_field_index("n_chars")
            part = part.set_column(at, "n_chars", pa.array([None if t is None else len(t) for t in texts], part.schema.field("n_chars").type))
        return part
    return _over(docs, field, build, docs.schema)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return found(docs, fit(docs.select("doc_id", "text")))
