"""What was changed between two texts, word by word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

_EDIT = StructType([StructField("op", StringType()), *[StructField(n, IntegerType()) for n in ("i1", "i2", "j1", "j2")], StructField("was", StringType()), StructField("now", StringType())])
EDITS = StructType([StructField("similarity", DoubleType()), StructField("edits", ArrayType(_EDIT))])


def _lengths(a: list, b: list) -> np.ndarray:
    """For each beginning of b the length of the longest common subsequence with all of a.

    One bit for each word of b in one whole number: what it costs is a step of machine words for each word of a, and
    the memory is that number and one for each different word.
    """
    places: dict = {}
    for j, w in enumerate(b):
        places[w] = places.get(w, 0) | (1 << j)
    full = (1 << len(b)) - 1
    row = full
    for w in a:
        if hit := row & places.get(w, 0):
            row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes((len(b) + 7) // 8, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.append(0, np.cumsum(1 - bits.astype(np.int64)))


def matched(a: list, b: list) -> list[tuple[int, int]]:
    """The places (in a, in b) of a longest common subsequence, in order, by halving a and cutting b where both halves share most."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, at, to = todo.pop()
        while lo < hi and at < to and a[lo] == b[at]:
            out.append((lo, at))
            lo, at = lo + 1, at + 1
        while lo < hi and at < to and a[hi - 1] == b[to - 1]:
            hi, to = hi - 1, to - 1
            out.append((hi, to))
        if lo >= hi or at >= to:
            continue
        if hi - lo == 1:
            if a[lo] in b[at:to]:
                out.append((lo, b.index(a[lo], at, to)))
            continue
        mid, own = (lo + hi) // 2, b[at:to]
        cut = at + int((_lengths(a[lo:mid], own) + _lengths(a[mid:hi][::-1], own[::-1])[::-1]).argmax())
        todo += [(lo, mid, at, cut), (mid, hi, cut, to)]
    return sorted(out)


def opcodes(a: list, b: list) -> list[tuple[str, int, int, int, int]]:
    """(op, i1, i2, j1, j2): runs of equal, replace, delete and insert that make b of a."""
    shared = set(a) & set(b)  # other words match nothing
    one, two = ([(k, w) for k, w in enumerate(x) if w in shared] for x in (a, b))
    pairs = [(one[i][0], two[j][0]) for i, j in matched([w for _, w in one], [w for _, w in two])]
    out, i, j = [], 0, 0
    for x, y in [*pairs, (len(a), len(b))]:
        if x > i or y > j:
            out.append(("replace" if x > i and y > j else "delete" if x > i else "insert", i, x, j, y))
        if x < len(a) and y < len(b):
            if out and out[-1][0] == "equal" and out[-1][2] == x and out[-1][4] == y:
                out[-1] = ("equal", out[-1][1], x + 1, out[-1][3], y + 1)
            else:
                out.append(("equal", x, x + 1, y, y + 1))
        i, j = x + 1, y + 1
    return out


def compared(old: str | None, new: str | None) -> dict:
    a, b = (old or "").split(), (new or "").split()
    ops = opcodes(a, b)
    same = sum(i2 - i1 for op, i1, i2, _, _ in ops if op == "equal")
    edits = [{"op": op, "i1": i1, "i2": i2, "j1": j1, "j2": j2, "was": " ".join(a[i1:i2]), "now": " ".join(b[j1:j2])} for op, i1, i2, j1, j2 in ops if op != "equal"]
    return {"similarity": round(2 * same / (len(a) + len(b)), 3) if a or b else 1.0, "edits": edits}


@F.arrow_udf(EDITS)
def word_edits(before: pa.Array, after: pa.Array) -> pa.Array:
    """Likeness, twice the words that stay by those of both texts, 1 for two empty ones, and all that was changed in order; null texts are empty.

    Edits of some rows at a time are held as Python's, those of a batch as Arrow's.
    """
    step, kind = 256, to_arrow_type(EDITS)
    parts = [pa.array([compared(x.as_py(), y.as_py()) for x, y in zip(before.slice(lo, step), after.slice(lo, step))], kind) for lo in range(0, len(before), step)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
