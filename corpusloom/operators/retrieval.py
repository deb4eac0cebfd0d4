"""Chunks, vectors and exact retrieval."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.order import first_n, running_sum
from corpusloom.session import bounded, spread, written

#: Tokens of a chunk, tokens it repeats of the one before, and tokens an abstract needs for a chunk of its own.
CHUNK, OVERLAP, ABSTRACT = 512, 128, 30
# The lines that head a document, and what ends the fields of its text.
HEAD_LINES = ("Title", "Authors", "Year", "Venue", "Keywords")
FIELDS = {"abstract": ("Abstract:", ("Full Text:", "Keywords:")), "body": ("Full Text:", ())}


#: White space as Python's ``str.split`` takes it: the characters, and their class in Java's patterns.
WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _let(value: Column, body) -> Column:
    """A value bound to a name, so that it is computed once."""
    return F.transform(F.array(value), body)[0]


def tokens(text: Column) -> Column:
    """Words times 1.3, rounded down, of a text without white space at its ends."""
    return F.when(text == "", 0).otherwise(F.floor(F.size(F.split(text, f"{_SPACE}++", -1)) * F.lit(1.3)).cast("int"))


def _stripped(text: Column, behind: bool = True) -> Column:
    return F.btrim(text, F.lit(WHITE)) if behind else F.ltrim(text, F.lit(WHITE))


def _field(text: Column, start: str, ends: tuple[str, ...]) -> Column:
    """What follows a field's name and the white space behind it, up to a later line that begins with one of the ends; empty if
    the text has no such field. (An empty field so has the next one's name in it.)"""
    at = F.instr(text, start)
    rest = _stripped(F.substr(text, at + len(start)), behind=False)

    def cut(rest: Column) -> Column:
        stops = [F.nullif(F.instr(rest, f"\n{end}"), F.lit(0)) for end in ends]
        return _stripped(F.left(rest, F.coalesce(F.least(*stops, F.char_length(rest) + 1), F.char_length(rest) + 1) - 1) if stops else rest)

    return F.when(at > 0, _let(rest, cut)).otherwise("")


def parts(text: Column | str, compat: bool = True) -> Column | tuple[str, str, str]:
    """Title, abstract and body as a struct; of a string, which is a text and no column's name, they are computed and come as a tuple.
    A text without a title line is all body. ``compat`` gives a text with an abstract but no ``Full Text:`` no body; else its body is
    what follows the abstract's first paragraph."""
    if isinstance(text, str):
        one = SparkSession.builder.getOrCreate().range(1)
        return tuple(one.select(parts(F.lit(text), compat).alias("found")).first().found)
    named_ = lambda title, abstract, body: F.struct(title.alias("title"), abstract.alias("abstract"), body.alias("body"))
    title = _stripped(F.split(_stripped(F.substr(text, F.lit(len("Title:") + 1)), behind=False), "\n", -1)[0])
    heads = rf"\A(?:(?:{'|'.join(HEAD_LINES)}):[^\n]*+(?:\n|\z))+"

    def chosen(x: Column) -> Column:
        gap = F.instr(x["abstract"], "\n\n")
        second = named_(x["title"], F.left(x["abstract"], gap - 1), _stripped(F.substr(x["abstract"], gap + 2)))
        lone = x if compat else F.when(gap > 0, second).otherwise(named_(x["title"], x["abstract"], F.lit("")))
        rest = named_(x["title"], F.lit(""), _stripped(F.regexp_replace(text, heads, "")))
        return F.when(x["body"] != "", x).when(x["abstract"] != "", lone).otherwise(rest)

    found = named_(title, *[_field(text, *limits) for limits in FIELDS.values()])
    return F.when(F.startswith(text, F.lit("Title:")), _let(found, chosen)).otherwise(named_(F.lit(""), F.lit(""), _stripped(text)))


def _pack(held: Column, sizes: Column, size: Column, out: Column) -> Column:
    """What a fold carries: the pieces of the open chunk, their tokens, how many it counts, and the chunks so far."""
    return F.struct(held.alias("held"), sizes.alias("sizes"), size.alias("size"), out.alias("out"))


def _added(pack: Column, text: Column, size: Column) -> Column:
    return _pack(F.array_append(pack["held"], text), F.array_append(pack["sizes"], size), pack["size"] + size, pack["out"])


def _taken(pack: Column, glue: str) -> Column:
    """The open chunk put to the others; of its last pieces those of ``OVERLAP`` tokens stay for the next one."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("size"), F.lit(True).alias("on"))
    more = lambda t, x: F.when(t["on"] & (t["size"] + x <= OVERLAP), F.struct((t["n"] + 1).alias("n"), (t["size"] + x).alias("size"), F.lit(True).alias("on"))).otherwise(F.struct(t["n"].alias("n"), t["size"].alias("size"), F.lit(False).alias("on")))
    tail = F.aggregate(F.reverse(pack["sizes"]), start, more)
    last = lambda array, t: F.slice(array, F.size(array) - t["n"] + 1, t["n"])
    return _let(tail, lambda t: _pack(last(pack["held"], t), last(pack["sizes"], t), t["size"], F.array_append(pack["out"], F.array_join(pack["held"], glue))))


def _folded(pack: Column, piece: Column, glue: str) -> Column:
    """One more piece; a chunk that it would fill over is taken first."""
    full = (F.size(pack["held"]) > 0) & (pack["size"] + piece["size"] > CHUNK)
    return _let(F.when(full, _taken(pack, glue)).otherwise(pack), lambda p: _added(p, piece["text"], piece["size"]))


def chunks(text: Column, compat: bool = True) -> Column:
    """Array of (``type``, ``text``): the abstract, then packed paragraphs; long paragraphs are packed by sentences, and their rest goes
    on as the only paragraph held. A fold over arrays in Spark's own functions."""
    none = F.array().cast("array<string>")
    sized = lambda s: F.struct(s.alias("text"), tokens(s).alias("size"))

    def paragraph(pack: Column, p: Column) -> Column:
        closed = F.when(F.size(pack["held"]) > 0, _taken(pack, "\n\n")).otherwise(pack)

        def by_sentence(before: Column) -> Column:
            sentences = F.transform(F.split(p["text"], rf"(?<=[.!?]){_SPACE}+", -1), sized)
            inner = F.aggregate(sentences, _pack(none, F.array().cast("array<int>"), F.lit(0), before["out"]), lambda a, s: _folded(a, s, " "))
            rest = lambda i: _let(F.array_join(i["held"], " "), lambda t: _pack(F.array(t), F.array(tokens(t)), i["size"], i["out"]))
            return _let(inner, rest)

        return F.when(p["size"] <= CHUNK, _folded(pack, p, "\n\n")).otherwise(_let(closed, by_sentence))

    def told(x: Column) -> Column:
        pieces = F.transform(F.filter(F.transform(F.split(x["body"], rf"\n{_SPACE}*\n", -1), lambda p: _stripped(p)), lambda p: p != ""), sized)
        packed = F.aggregate(pieces, _pack(none, F.array().cast("array<int>"), F.lit(0), none), paragraph)
        whole = _let(packed, lambda p: F.when(F.size(p["held"]) > 0, F.array_append(p["out"], F.array_join(p["held"], "\n\n"))).otherwise(p["out"]))
        prefix = F.when(x["title"] != "", F.concat(F.lit("Title: "), x["title"], F.lit("\n"))).otherwise("")
        kind = lambda name, t: F.struct(F.lit(name).alias("type"), F.concat(prefix, t).alias("text"))
        abstract = F.when(tokens(x["abstract"]) > ABSTRACT, F.array(kind("abstract", F.concat(F.lit("Abstract: "), x["abstract"])))).otherwise(F.array().cast("array<struct<type:string,text:string>>"))
        return F.concat(abstract, F.transform(whole, lambda t: kind("fulltext", t)))

    return _let(parts(text, compat), told)


def chunk_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", compat: bool = True) -> DataFrame:
    """``id``, ``chunk_no`` from 0, ``chunk_type`` and ``text`` of every chunk of every document."""
    plain = spread(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))
    return plain.select("id", F.posexplode(chunks(F.col("text"), compat)).alias("chunk_no", "c")).select("id", "chunk_no", F.col("c.type").alias("chunk_type"), F.col("c.text").alias("text"))


def dot(a: Column, b: Column) -> Column:
    """Inner product in doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalised(v: Column) -> Column:
    """The vector at length 1; a zero vector as it is."""
    length = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(0.0))


#: Queries of a block, and bytes of the blocks that go to every task at once.
QUERY_BLOCK, PASS_BYTES = 1024, 64 << 20


def _usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows with an id and a vector of finite numbers."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fit = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(fit).select(F.col(id_col).cast("bigint").alias("id"), x.alias("v"))


def _matrix(vectors: pd.Series, dims: int, cosine: bool) -> np.ndarray:
    """Vectors in rows, shorter ones padded with zeros."""
    m = np.zeros((len(vectors), dims))
    for row, v in zip(m, vectors, strict=True):
        row[: len(v)] = v
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) if cosine else m


def top_k(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", cosine: bool = False) -> DataFrame:
    """``query_id``, ``vec_id``, ``score`` and ``rank`` of every query's k candidates of the largest inner product, others than
    itself, ties by id. Vectors that are null or hold null or non-finite numbers take no part.

    A query set against all rows, in blocks: queries are packed into blocks by the executors, and a pass takes as many blocks
    to every candidate as fit ``PASS_BYTES``; a task scores its candidates against a block by one matrix product and keeps
    the best k, which are ranked again for every query.
    """
    bounded(queries.sparkSession)  # a row of a query block and a candidate block has about 1 MB
    wanted, rows = _usable(queries, id_col, vector_col), _usable(candidates, id_col, vector_col)
    asked = wanted.select(F.size("v").alias("dims"), F.lit(1).alias("n")).union(rows.select(F.size("v"), F.lit(0)))
    dims, n = asked.agg(F.coalesce(F.max("dims"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for frame in frames:
            for at in range(0, len(frame), QUERY_BLOCK):
                part = frame.iloc[at : at + QUERY_BLOCK]
                yield pd.DataFrame({"block": [number], "ids": [part["id"].to_numpy(np.int64).tobytes()], "data": [_matrix(part["v"], dims, cosine).tobytes()]})
                number += 1

    kinds = "block bigint, ids binary, data binary"
    blocks, others = wanted.mapInPandas(pack, kinds), rows.mapInPandas(pack, kinds)
    passes = [blocks]
    if n * 8 * (dims + 1) > PASS_BYTES:  # bytes of all queries' blocks
        blocks, size = written(blocks, "topk-queries"), (F.octet_length("ids") + F.octet_length("data")).cast("bigint")
        number = F.floor((F.col("upto") - 1) / PASS_BYTES).alias("pass")
        placed = running_sum(blocks.select("block", size.alias("size")), F.col("size"), "block", out="upto").select("block", number)
        numbered, others = written(blocks.join(placed, "block"), "topk-passes"), written(others, "topk-candidates")
        passes = [numbered.where(F.col("pass") == i) for i in range(numbered.agg(F.max("pass")).first()[0] + 1)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, keys, others in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, keys = np.frombuffer(ids, np.int64), np.frombuffer(keys, np.int64)
                scores = np.frombuffer(data).reshape(len(ids), dims) @ np.frombuffer(others).reshape(len(keys), dims).T
                out: list[tuple[np.ndarray, ...]] = []
                for one, row in zip(ids, scores, strict=True):
                    at = np.flatnonzero(keys != one)
                    at = at[np.lexsort((keys[at], -row[at]))[:k]]
                    out.append((np.full(len(at), one), keys[at], row[at]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    candidates_of = others.select(F.col("ids").alias("keys"), F.col("data").alias("others"))
    # PASS_BYTES and a block at the most go to every task
    found = [F.broadcast(some.select("ids", "data")).crossJoin(candidates_of).mapInArrow(score, "query_id bigint, vec_id bigint, score double") for some in passes]
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def first_chunks(chunked: DataFrame, n: int) -> DataFrame:
    """The first n chunks of every document."""
    return first_n(chunked, ["id"], ["chunk_no"], n)
