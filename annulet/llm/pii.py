"""Personal information inside free text: found by bootstrapped contexts, replaced by typed placeholders.

One pass over all texts counts which lexical patterns (words around a place) occur with which possible names, which
contexts numbers of which shape stand in, which words stand where an address names its street, how words are written,
and which towns close an address with a postcode. Spark scores these graphs of patterns and instances in rounds,
each from its seeds. Names start from a list: a pattern counts for what share of its distinct instances are known
names, a word for how much of its use lies in good patterns. Numbers start from words like "tel" or "passport"
before them, the international prefix and the mark of a patient's record: a context is good for a kind if enough of
its numbers have a known shape or such a word, a shape if most of its numbers stand in good contexts; a shape that
was hardly ever seen with such a word or among certain numbers is no candidate. Street words start from a list: a context counts for how many of its
addresses have known ones. What is above its threshold is known in the next round. A second pass applies the learned
model to every text.

The model holds only what occurs ``least`` times. Up to ``MOST`` entries it is sent to all tasks; a larger one stays a
table, and each chunk of texts gets the entries that its own words, contexts and shapes ask for (``_with_entries``).

Defined cases: null, empty and blank texts hold nothing; places never overlap (email, then numbers of persons,
addresses, phones, names); positions count Unicode code points; a name that only labels a thing is the one before
another capitalised word that is no name; an empty corpus or an empty list of names gives what forms alone give.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annulet.llm import pii_kernel
from annulet.session import cut, spread

ROUNDS, MOST = 4, 1_000_000
CHUNK = 1 << 24  # about so many code points in the texts of a chunk


def observations(df: DataFrame) -> DataFrame:
    """kind, a, b, c, n: what all texts show, counted in each batch before it is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = pii_kernel.Seen()
            for text in batch.column(0).to_pylist():
                seen.add(text)
            columns = list(zip(*seen.rows())) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns[:4]] + [pa.array(columns[4], pa.int64())], ["kind", "a", "b", "c", "n"])

    rows = spread(df.where("text is not null").select("text")).mapInArrow(run, "kind string, a string, b string, c string, n bigint")
    return rows.groupBy("kind", "a", "b", "c").agg(F.sum("n").alias("n"))


def good_patterns(edges: DataFrame, names: DataFrame, share: float = 0.5, least: int = 3) -> DataFrame:
    """Patterns of which at least ``least`` distinct instances, and this share of all, are known names."""
    known = edges.join(names.select("word", F.lit(1).alias("known")), "word", "left")
    scored = known.groupBy("pattern").agg(F.count("*").alias("words"), F.count("known").alias("hits"))
    return scored.where((F.col("hits") >= least) & (F.col("hits") >= share * F.col("words"))).select("pattern")


def good_words(edges: DataFrame, patterns: DataFrame, cases: DataFrame, share: float = 0.4, least: int = 2) -> DataFrame:
    """Words with this share of their use, and at least ``least`` patterns, among the good ones, and mostly in capitals."""
    seen = edges.join(patterns.select("pattern", F.lit(1).alias("good")), "pattern", "left")
    used = seen.groupBy("word").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good") == 1, F.col("n"))).alias("in_good"), F.count("good").alias("patterns"))
    used = used.where((F.col("patterns") >= least) & (F.col("in_good") >= share * F.col("n")))
    return used.join(cases.where("low <= cap and open <= 4 * cap").select("word"), "word").select("word")


def good_numbers(seen: DataFrame, rounds: int, least: int = 3) -> DataFrame:
    """kind, v: for 'phone' and 'id' contexts (that kind), shapes that tell alone (``_shape``) and those that tell in a good context (``_maybe``)."""
    rows = seen.where("kind = 'number'").select(F.explode(F.array(F.lit("phone"), F.lit("id"))).alias("kind"), F.col("a").alias("context"), F.col("b").alias("cue"), F.col("c").alias("shape"), "n")
    rows = rows.withColumn("said", F.col("cue") == F.col("kind"))
    hits = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).alias("hit")
    total = F.sum("n").alias("n")
    # As many shapes as there are ways to write a number; letters are in no phone number.
    is_id = F.col("kind") == "id"
    sure = F.when(is_id, F.col("shape") == "MRN").otherwise(F.col("shape").rlike(r"^(\+|009+[^9]+9+[^9])"))
    rows = rows.withColumn("sure", sure & (is_id | ~F.col("shape").rlike("[A-Z]")))
    # Candidates: shapes seen with such a word, or where half of all numbers are certain.
    first = rows.groupBy("kind", "context").agg(total, hits(F.col("said") | F.col("sure"))).where((F.col("hit") >= least) & (F.col("hit") * 2 >= F.col("n")))
    facts = rows.join(first.select("kind", "context", F.lit(True).alias("good")), ["kind", "context"], "left")
    facts = facts.groupBy("kind", "shape", "sure").agg(total, hits(F.col("said") | F.col("good")))
    enough = (F.col("hit") >= least) & (F.col("hit") * 100 >= F.col("n")) & (is_id | ~F.col("shape").rlike("[A-Z]"))
    maybe = facts.where(F.col("sure") | enough).select("kind", "shape")
    edges = cut(rows.join(maybe, ["kind", "shape"]).groupBy("kind", "context", "shape", "said", "sure").agg(total))
    shapes = edges.where("sure").select("kind", "shape").distinct()
    for _ in range(rounds):
        known = edges.join(shapes.withColumn("known", F.lit(True)), ["kind", "shape"], "left")
        contexts = known.groupBy("kind", "context").agg(total, hits(F.col("said") | F.col("known"))).where((F.col("hit") >= least) & (F.col("hit") >= 0.2 * F.col("n")))
        contexts = cut(contexts.select("kind", "context"))
        inside = edges.join(contexts.withColumn("good", F.lit(True)), ["kind", "context"], "left")
        held = inside.groupBy("kind", "shape").agg(total, hits(F.col("said") | F.col("good"))).where((F.col("hit") >= least) & (F.col("hit") >= 0.6 * F.col("n")))
        shapes = held.select("kind", "shape")
    out = contexts.select("kind", F.col("context").alias("v"))
    for name, df in (("_shape", shapes), ("_maybe", edges.select("kind", "shape").distinct())):
        out = out.unionByName(df.select(F.concat("kind", F.lit(name)).alias("kind"), F.col("shape").alias("v")))
    return out


def good_streets(seen: DataFrame, rounds: int = 2, least: int = 3) -> DataFrame:
    """kind 'street', v: words that name streets, beyond the listed ones."""
    rows = seen.where("kind = 'street'").select(F.col("a").alias("word"), F.col("b").alias("context"), (F.col("c") == "coded").alias("coded"), "n")
    words = rows.where("word = ''").select("word").distinct()
    for _ in range(rounds):
        known = rows.join(words.select("word", F.lit(1).alias("known")), "word", "left")
        contexts = known.groupBy("context").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("known") == 1, F.col("n")).otherwise(0)).alias("hit"))
        contexts = contexts.where((F.col("hit") >= least) & (F.col("hit") >= 0.5 * F.col("n"))).select("context", F.lit(1).alias("good"))
        inside = rows.join(contexts, "context", "left").withColumn("hit", F.when(F.col("coded") | (F.col("good") == 1), F.col("n")).otherwise(0))
        held = inside.groupBy("word").agg(F.sum("n").alias("n"), F.sum("hit").alias("hit"))
        words = (held.where((F.col("word") == "") | ((F.col("hit") >= least) & (F.col("hit") >= 0.6 * F.col("n")))).select("word"))
    return words.where("word <> ''").select(F.lit("street").alias("kind"), F.col("word").alias("v"))


def good_names(seen: DataFrame, person_words: DataFrame, rounds: int, least: int) -> DataFrame:
    """kind, v: names, listed and learned, words that are names only where people are named, and contexts of people."""
    edges = seen.where("kind = 'edge'").select(F.col("a").alias("pattern"), F.col("b").alias("word"), "n")
    cases = seen.where("kind = 'case'").groupBy(F.col("a").alias("word")).agg(
        *(F.sum(F.when(F.col("b") == c, F.col("n")).otherwise(0)).alias(c) for c in ("cap", "low", "open", "han"))
    )
    listed = person_words.where(r"word rlike '\\S'").select(F.lower(F.trim("word")).alias("word"), F.coalesce("word_kind", F.lit("")).alias("kind")).distinct()
    seeds = listed.groupBy("word").agg(F.max(F.col("kind") == "either").alias("either"))
    names, either = seeds.where("not either").select("word"), seeds.where("either").select("word")
    known = names = names.unionByName(cases.where(f"han >= {least}").select("word")).distinct()
    for _ in range(rounds):
        patterns = good_patterns(edges, known)
        found = good_words(edges, patterns, cases).join(either, "word", "left_anti")
        known = cut(names.unionByName(found).distinct())
    persons = good_patterns(edges, known, share=0.8).withColumnRenamed("pattern", "word")
    parts = [words.select(F.lit(kind).alias("kind"), F.col("word").alias("v")) for kind, words in (("name", known), ("either", either), ("person", persons))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def learned(df: DataFrame, person_words: DataFrame, rounds: int = ROUNDS, least: int = 2) -> DataFrame:
    """kind, v: the model of a corpus (text) and an incomplete list of names (word, word_kind), as a table."""
    seen = cut(observations(df))
    towns = seen.where(f"kind = 'town' and n >= {least}").select("kind", F.col("a").alias("v"))
    # The three graphs have nothing to do with each other, so their rounds run side by side.
    with ThreadPoolExecutor(3) as side_by_side:
        parts = [side_by_side.submit(f, *a) for f, a in ((good_names, (seen, person_words, rounds, least)), (good_numbers, (seen, rounds)), (good_streets, (seen,)))]
        names, numbers, streets = (p.result() for p in parts)
    return cut(names.unionByName(numbers).unionByName(streets).unionByName(towns).distinct())


def model_of(kinds: list[str], values: list[str]) -> pii_kernel.Model:
    model = pii_kernel.Model()
    for kind, v in zip(kinds, values):
        getattr(model, kind).add(v)
    return model


def _with_model(docs: DataFrame, model: DataFrame, apply: Callable[[pa.RecordBatch, pii_kernel.Model], pa.RecordBatch], schema: str) -> DataFrame:
    """``apply`` on batches of (doc_id, text) with the model, or with the part of it that the texts of a chunk can ask for."""
    rows = model.limit(MOST + 1).collect()
    if len(rows) <= MOST:
        small = docs.sparkSession.sparkContext.broadcast(model_of([r["kind"] for r in rows], [r["v"] for r in rows]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield apply(batch, small.value)

        return spread(docs).mapInArrow(run, schema)
    return _with_entries(docs, model, apply, schema)


def _with_entries(docs: DataFrame, model: DataFrame, apply: Callable[[pa.RecordBatch, pii_kernel.Model], pa.RecordBatch], schema: str) -> DataFrame:
    size = docs.agg(F.coalesce(F.sum(F.length("text").cast("bigint")), F.lit(0))).first()[0]
    chunks = max(docs.sparkSession.sparkContext.defaultParallelism, size // CHUNK + 1)
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(chunks)))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = {(c, v) for c, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if text is not None for v in pii_kernel.asked(text)}
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in pairs], pa.int64()), pa.array([v for _, v in pairs], pa.string())], ["chunk", "v"])

    wanted = docs.select("chunk", "text").mapInArrow(asked, "chunk bigint, v string").distinct().join(model, "v")

    def both(texts: pa.Table, entries: pa.Table) -> pa.Table:
        part = model_of(entries["kind"].to_pylist(), entries["v"].to_pylist())
        out = [apply(b, part) for b in texts.select(["doc_id", "text"]).to_batches(max_chunksize=10_000)]
        return pa.Table.from_batches(out) if out else apply(pa.RecordBatch.from_pylist([], texts.select(["doc_id", "text"]).schema), part)

    return docs.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(both, schema)


def find(df: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, kind, start_pos, end_pos of every place in rows (doc_id, text)."""

    def places(batch: pa.RecordBatch, m: pii_kernel.Model) -> pa.RecordBatch:
        ids, kinds, starts, ends = [], [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for kind, s, e in pii_kernel.find(text, m):
                ids.append(doc), kinds.append(kind), starts.append(s), ends.append(e)
        columns = [pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "kind", "start_pos", "end_pos"])

    rows = df.where("text is not null").select(F.col("doc_id").cast("bigint"), "text")
    return _with_model(rows, model, places, "doc_id bigint, kind string, start_pos int, end_pos int")


def redact(df: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, text with ``[EMAIL]``, ``[PHONE]``, ``[ID_NUMBER]``, ``[ADDRESS]``, ``[PERSON]`` for the places, otherwise unchanged."""

    def replaced(batch: pa.RecordBatch, m: pii_kernel.Model) -> pa.RecordBatch:
        texts = []
        for text in batch.column(1).to_pylist():
            if text is not None:
                parts, at = [], 0
                for kind, s, e in pii_kernel.find(text, m):
                    parts += [text[at:s], f"[{kind.upper()}]"]
                    at = e
                text = "".join([*parts, text[at:]])
            texts.append(text)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return _with_model(df.select(F.col("doc_id").cast("bigint"), "text"), model, replaced, "doc_id bigint, text string")
