"""Fuzzy line dedup by MinHash.

Lines are sets of eight-character shingles. Their sketches are filled round by
round until no bin is empty, so short lines fill them too; lines that share a
band (see ``banding``) are candidates. Exact Jaccard similarity of the shingle
sets decides, and distributed union-find joins the links to components, of
which the first line of the corpus stays. Equal lines are one line from the
start, and texts are fetched for candidates only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import banding
from tickloom.llm._common import KEY, Store, bit_table, fresh, in_table, keyed, parallelism, slices
from tickloom.llm.banding import ODD, PACKED, Forest, band_keys, mixed, packed
from tickloom.llm.components import components

SHINGLE, SIMILAR = 8, 0.8
#: Lines of a candidate group up to which its pairs are compared in one sort; beyond, by tables of BLOCK lines and TABLE cells at most.
SMALL, BLOCK, TABLE = 16, 1024, 2 << 20
#: Bits of a shingle's code.
CODE = 50


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """(number, line) of the lines with more than blanks; blanks at the ends don't count."""
    return [(k, s) for k, x in enumerate((text or "").split("\n")) if (s := x.strip())]


def line_ids(lines: list[str]) -> np.ndarray:
    """Two 64-bit hashes of each line; the first is its id."""
    digests = b"".join([xxhash.xxh3_128_digest(x.encode()) for x in lines])
    return np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)


def shingles(lines: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code of every shingle of every line, and the number of the line it belongs to; lines below ``size`` have none."""
    lengths = np.array([len(x) for x in lines], np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(points) < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    code, width = points, 1
    while width < size:
        code = code[:-width] * np.uint64(pow(ODD[0], width, 1 << 64)) + code[width:]
        width *= 2
    owner = np.repeat(np.arange(len(lines)), lengths)[: len(code)]
    whole = np.arange(len(code)) + size <= np.cumsum(lengths)[owner]
    return code[whole], owner[whole]


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending; sorts in place (numpy's unique hashes, which is far slower here)."""
    values.sort()
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


class Teams:
    """Exact comparison of the lines of many candidate groups at once.

    A line's shingles are a sorted run of distinct 50-bit codes; a pair's common
    shingles are the equal neighbours after sorting both runs together, many
    pairs in one sort. Before two components are joined, the shingles
    themselves of the pair that joins them are compared.
    """

    def __init__(self, lines: list[str]):
        self.lines = lines
        codes, owner = shingles(lines)
        n = len(lines)
        most = 1 << (64 - CODE)
        parts = []
        for at in range(0, n, most):
            low, high = np.searchsorted(owner, [at, at + most])
            key = (owner[low:high] - at).astype(np.uint64) << np.uint64(CODE) | mixed(codes[low:high], 5) >> np.uint64(64 - CODE)
            parts.append(distinct(key))
        self.size = np.concatenate([np.bincount((p >> np.uint64(CODE)).astype(np.int64), minlength=min(most, n - k * most)) for k, p in enumerate(parts)]) if parts else np.zeros(0, np.int64)
        self.codes = np.concatenate(parts) & np.uint64((1 << CODE) - 1) if parts else np.empty(0, np.uint64)
        self.start = np.cumsum(self.size) - self.size

    def exact(self, a: int, b: int) -> bool:
        """Whether two lines' shingle sets have a Jaccard similarity of SIMILAR."""
        x, y = ({s[k : k + SHINGLE] for k in range(len(s) - SHINGLE + 1)} for s in (self.lines[a], self.lines[b]))
        common = len(x & y)
        return common >= SIMILAR * (len(x) + len(y) - common) - 1e-6

    def similar(self, left: np.ndarray, right: np.ndarray, least: float = SIMILAR) -> np.ndarray:
        """Whether each pair of lines has a Jaccard similarity of ``least``."""
        out = np.zeros(len(left), bool)
        weight = np.cumsum(self.size[left] + self.size[right])
        at = 0
        while at < len(left):
            before = weight[at - 1] if at else 0
            end = min(at + 4096, max(at + 1, int(np.searchsorted(weight, before + (1 << 21), side="right"))))
            a, b = left[at:end], right[at:end]
            which = np.concatenate([a, b])
            pair = np.tile(np.arange(end - at), 2)
            size = self.size[which]
            from_ = np.repeat(self.start[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            key = np.repeat(pair, size).astype(np.uint64) << np.uint64(CODE) | self.codes[from_]
            key.sort()
            same = key[1:][key[1:] == key[:-1]] >> np.uint64(CODE)
            common = np.bincount(same.astype(np.int64), minlength=end - at)
            out[at:end] = common >= least * (self.size[a] + self.size[b] - common) - 1e-6
            at = end
        return out

    def links(self, teams: list[np.ndarray]) -> list[tuple[int, int]]:
        """Links that span the components of the teams' similar lines; no similar pair of a team is left apart.

        The pairs of small teams are compared in one go, each pair once;
        larger teams by products of their shingle tables.
        """
        forest = Forest(len(self.lines))
        small = [t for t in teams if len(t) <= SMALL]
        if small:
            by_size: dict[int, list[np.ndarray]] = {}
            for t in small:
                by_size.setdefault(len(t), []).append(t)
            pairs = [np.stack(own)[:, np.stack(np.triu_indices(n, 1))] for n, own in by_size.items()]
            left = np.concatenate([p[:, 0].ravel() for p in pairs])
            right = np.concatenate([p[:, 1].ravel() for p in pairs])
            both = distinct(np.minimum(left, right) * len(self.size) + np.maximum(left, right))
            left, right = np.divmod(both, len(self.size))
            # Sets whose sizes differ more cannot be similar.
            close = np.minimum(self.size[left], self.size[right]) >= SIMILAR * np.maximum(self.size[left], self.size[right]) - 1e-6
            left, right = left[close], right[close]
            near = self.similar(left, right)
            for a, b in zip(left[near].tolist(), right[near].tolist(), strict=True):
                self._join(forest, a, b)
        for team in teams:
            if len(team) > SMALL:
                self._large(team, forest)
        return forest.links()

    def _join(self, forest: Forest, a: int, b: int) -> None:
        if forest.root(a) != forest.root(b) and self.exact(a, b):
            forest.join(a, b)

    def _large(self, team: np.ndarray, forest: Forest) -> None:
        """Join the similar lines of a large team. Blocks that are connected already are not compared."""
        size = self.size[team]
        row = np.repeat(np.arange(len(team)), size)
        codes = self.codes[np.repeat(self.start[team] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        order = np.argsort(codes)
        codes, row = codes[order], row[order]
        group = np.cumsum(np.append(True, codes[1:] != codes[:-1])[: len(codes)]) - 1
        # Shingles of one line only are common to none.
        shared = np.bincount(group) > 1
        kept = shared[group]
        column, row = (np.cumsum(shared) - 1)[group[kept]], row[kept]
        width = max(256, TABLE // min(len(team), BLOCK))
        names = team.tolist()

        def parts(of: np.ndarray) -> np.ndarray:
            return np.array([forest.root(names[k]) for k in of.tolist()])

        for i in range(0, len(team), BLOCK):
            a = np.arange(i, min(i + BLOCK, len(team)))
            for j in range(i, len(team), BLOCK):
                b = np.arange(j, min(j + BLOCK, len(team)))
                if len(set(parts(a).tolist()) | set(parts(b).tolist())) == 1:
                    continue
                common = np.zeros((len(a), len(b)), np.float32)
                for at in range(0, int(shared.sum()), width):
                    low, high = np.searchsorted(column, [at, at + width])
                    rows, columns = row[low:high], column[low:high] - at
                    tables = []
                    for own in (a, b) if i != j else (a,):
                        mine = (rows >= own[0]) & (rows <= own[-1])
                        tables.append(np.zeros((len(own), min(width, int(shared.sum()) - at)), np.float32))
                        tables[-1][rows[mine] - own[0], columns[mine]] = 1
                    common += tables[0] @ tables[-1].T
                near = common >= SIMILAR * (size[a][:, None] + size[b][None, :] - common) - 1e-6
                for k in np.flatnonzero(near.any(axis=1)).tolist():
                    others = b[near[k]]
                    met = parts(others)
                    for x in others[met != forest.root(names[a[k]])].tolist():
                        self._join(forest, names[a[k]], names[x])


def _occurrences(rows: DataFrame) -> DataFrame:
    """A row for each line: the document's key, the line's number and its 128-bit id; ``head`` marks the first row of each document. Documents without lines have one row with a null number."""
    schema = "doc_id long, h1 long, h2 long, number long, line long, line2 long, head long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, number, lines = [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                own = lines_of(text) or [(None, "")]
                at += [k] * len(own)
                number += [n for n, _ in own]
                lines += [line for _, line in own]
            ids, at = line_ids(lines), np.array(at)
            head = np.append(True, at[1:] != at[:-1]).astype(np.int64)
            keys = [batch.column(c).take(pa.array(at)) for c in KEY]
            columns = [pa.array(number, pa.int64()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(head)]
            yield pa.RecordBatch.from_arrays([*keys, *columns], [x.split()[0] for x in schema.split(", ")])

    return rows.select(*KEY, "text").mapInArrow(scan, schema)


def bands(lines: list[str]) -> np.ndarray:
    """One 64-bit key for each line and band."""
    return band_keys(*shingles(lines), len(lines))


def _band_rows(rows: DataFrame, shares: int) -> DataFrame:
    """(share, packed): the band keys and ids of each distinct line of a slice."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=2 << 20):
            own = list(dict.fromkeys(line for text in batch.column("text").to_pylist() for _, line in lines_of(text) if len(line) >= SHINGLE))
            if own:
                yield packed(bands(own), line_ids(own)[:, 0], shares)

    return rows.select("text").mapInArrow(scan, PACKED)


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line, line2, content) of the wanted line ids, read from the documents through a bit table of fixed size; of lines whose first hashes are equal, one."""
    shared = rows.sparkSession.sparkContext.broadcast(bit_table(wanted, "line"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in slices(batches):
            own = list(dict.fromkeys(line for text in batch.column("text").to_pylist() for _, line in lines_of(text) if len(line) >= SHINGLE))
            if not own:
                continue
            ids = line_ids(own)
            hit = np.flatnonzero(in_table(bits, ids[:, 0].copy()))
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit, 0]), pa.array(ids[hit, 1]), pa.array([own[k] for k in hit.tolist()], pa.string())], ["line", "line2", "content"])

    found = rows.select("text").mapInArrow(scan, "line long, line2 long, content string").join(wanted, "line", "left_semi")
    return found.groupBy("line").agg(F.min("line2").alias("line2"), F.min_by("content", "line2").alias("content"))


def judged_lines(docs: DataFrame, store: Store | None = None) -> DataFrame:
    """(doc_id, h1, h2, rows, n_lines, removed array<long>, joined array<long>) for each distinct (doc_id, text).

    ``removed`` are the numbers of the lines that another line of their
    component precedes, by doc_id (null first), text hash and number;
    ``joined`` are the ids of the components that the document's lines belong
    to and that hold several lines, ascending; ``rows`` is how often the row
    occurs. A line's id is a 64-bit hash of its stripped text. Equal lines, and
    the lines that a link stands for, are told by 128 bits: where two lines
    share an id, one of them loses its links, but no line is taken for another.
    """
    store = store or Store(docs.sparkSession)
    parts = parallelism(docs.sparkSession)
    rows = keyed(docs)
    seen = store.keep(_occurrences(rows))
    enough = max(parts, -(-seen.count() * banding.BANDS // banding.TASK_ROWS))
    groups = store.keep(banding.groups(_band_rows(rows, banding.SHARES * enough), enough).distinct())
    wanted = store.keep(groups.select("line").distinct())
    texts = store.keep(_texts(rows, wanted))
    links = banding.links(groups, texts, store, parts, Teams)
    roots = components(links, store).withColumnRenamed("node", "line")
    roots = store.keep(roots.join(texts.select("line", "line2"), "line"))
    store.drop(groups, texts, wanted)

    named = seen.where("number is not null").join(roots, ["line", "line2"], "left")
    named = named.select(*KEY, "number", F.coalesce("root", "line").alias("part"), F.when(F.col("root").isNull(), F.col("line2")).otherwise(0).alias("part2"))
    named = store.keep(named)
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), *KEY, "number")
    firsts = store.keep(named.groupBy("part", "part2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("part", "part2", "first"))
    shared = named.join(firsts, ["part", "part2"]).select(*KEY, "number", "part", (place == F.col("first")).alias("stays"))
    per_doc = shared.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.when(~F.col("stays"), F.col("number")))).alias("removed"), F.sort_array(F.collect_set("part")).alias("joined"))
    counts = seen.groupBy(*KEY).agg(F.sum("head").cast("int").alias("rows"), F.count("number").alias("n")).withColumn("n_lines", F.expr("n div rows")).drop("n")
    # Null ids meet through an equal stand-in, so the join stays an equality join.
    met = counts.alias("c").join(per_doc.alias("p"), [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in KEY], "left")
    none = F.array().cast("array<long>")
    return met.select(*(f"c.{k}" for k in KEY), "rows", "n_lines", F.coalesce("removed", none).alias("removed"), F.coalesce("joined", none).alias("joined"))


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed, components) for each row of ``docs``.

    ``removed`` lists the numbers (from 0, among all lines of the text) of the
    lines that go, ``components`` the ids of the components of several lines
    that the document has part in. Lines of blanks only are no lines and
    always stay. Nulls: a null text has no lines; a null doc_id keeps its row
    and comes first. Repeated rows repeat, and are one document: their lines
    count once. Lines below eight characters match exactly only. Other columns
    are not read.
    """
    judged = judged_lines(docs)
    return judged.select(
        "doc_id",
        "n_lines",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join("removed", ",").alias("removed"),
        F.array_join("joined", ",").alias("components"),
        F.explode(F.array_repeat(F.lit(1), F.col("rows"))).alias("_"),
    ).drop("_")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeated lines; n_chars follows, and a document that loses all its lines goes.

    Columns are those of ``docs``. Identical rows lose the same lines. Nulls: a
    null text has no lines and stays null, as do empty texts and texts of
    blanks; a null doc_id keeps its row and comes first. Of lines in one place
    of the order (rows of one doc_id) the text's hash, then the number decides.
    An empty table gives an empty one.
    """
    judged = judged_lines(docs).select(*KEY, "n_lines", "removed").where(F.size("removed") > 0)
    one, two, gone = fresh(docs, "hash"), fresh(docs, "hash2"), fresh(docs, "gone")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.withColumn(one, F.xxhash64(text)).withColumn(two, F.xxhash64(F.lit("second"), text))
    right = judged.select(F.col("doc_id").alias("_d"), F.col("h1").alias("_1"), F.col("h2").alias("_2"), F.col("n_lines").alias("_n"), F.col("removed").alias(gone))
    same = (base[one] == right["_1"]) & (base[two] == right["_2"]) & base["doc_id"].eqNullSafe(right["_d"])
    met = base.join(right, same, "left").where(F.col(gone).isNull() | (F.size(gone) < F.col("_n")))
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda _, k: ~F.array_contains(F.col(gone), k.cast("long"))), "\n")
    edited = {"text": F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)}
    if "n_chars" in docs.columns:
        edited["n_chars"] = F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length(kept)).cast(docs.schema["n_chars"].dataType)
    return met.select(*(edited[c].alias(c) if c in edited else base[c] for c in docs.columns))
