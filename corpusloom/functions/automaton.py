"""Many terms of many lists in one pass over a text, by a shared automaton.

The terms of all lists make one automaton of multi-pattern search, so a text is read once whatever the number of terms. It is built
and packed once, its size is checked, and every task unpacks it once. Lists are the caller's data.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.columns import free, named
from corpusloom.session import bounded, spread

#: Bytes of a packed automaton; larger lists are cut into several tables by the caller, each shipped for itself.
MOST_BYTES = 512 << 20


def _in_word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


class Automaton:
    """Lists of lower-cased terms. A list in ``whole`` finds its terms as whole words only (letters and digits of any script)."""

    def __init__(self, lists: dict[str, Iterable[str]], whole: Iterable[str] = ()):
        import ahocorasick  # only here, so that the rest of the library does without it

        self.names = sorted(lists)
        self.whole = frozenset(self.names.index(n) for n in whole)
        owners: dict[str, list[int]] = {}
        for i, name in enumerate(self.names):
            for term in {t.lower() for t in lists[name] if t}:
                owners.setdefault(term, []).append(i)
        self.machine = ahocorasick.Automaton()
        for term, of in owners.items():
            self.machine.add_word(term, (term, tuple(of)))
        if owners:
            self.machine.make_automaton()
        self.empty = not owners

    def found(self, text: str | None) -> dict[int, set[str]]:
        """The terms of each list that stand in a lower-cased text, by the list's place in ``names``."""
        out: dict[int, set[str]] = {}
        if self.empty or not text:
            return out
        for end, (term, of) in self.machine.iter(text):
            for i in of:
                if i not in self.whole or not (_in_word(text, end + 1) and _in_word(text, end) or _in_word(text, end - len(term)) and _in_word(text, end - len(term) + 1)):
                    out.setdefault(i, set()).add(term)
        return out


def lexicon_hits(df: DataFrame, text_col: str, automaton: Automaton) -> DataFrame:
    """``df`` with the distinct terms of every list that its text contains, sorted: arrays under the lists' names (with underscores
    behind those that are taken). Null texts count as empty."""
    spark = df.sparkSession
    bounded(spark)
    packed = pickle.dumps(automaton)
    if len(packed) > MOST_BYTES:
        raise ValueError(f"the automaton has {len(packed)} bytes, more than {MOST_BYTES}")
    shared, names = spark.sparkContext.broadcast(packed), free(df, *automaton.names)
    plain = df.select(*[named(c).alias(f"c{i}") for i, c in enumerate(df.columns)], F.lower(named(text_col).cast("string")).alias("text"))
    fields = plain.schema.fields[:-1]
    schema = T.StructType([*fields, *(T.StructField(f"h{i}", T.ArrayType(T.StringType())) for i in range(len(names)))])
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: Automaton = pickle.loads(shared.value)
        for batch in batches:
            told = [machine.found(text.as_py()) for text in batch.columns[-1]]
            hits = [pa.array([sorted(t.get(i, ())) for t in told], pa.list_(pa.string())) for i in range(len(names))]
            yield pa.record_batch([*(c if c.type == t else c.cast(t) for c, t in zip(batch.columns[:-1], types, strict=True)), *hits], names=[f.name for f in schema])

    return spread(plain).mapInArrow(run, schema).toDF(*df.columns, *names)
