"""The byte-context model of one process, for comparison: contexts of words in a dict."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written
from millrace.llm.ppm import BLANK, END, VOCABULARY, counted


def context_counts(words: DataFrame, order: int) -> DataFrame:
    """(word, n): contexts up to ``order`` bytes, each with one following symbol as its last byte, of short texts
    with counts. With ``context_trie`` and ``Scorer`` it is the plain model of one process, for comparison."""
    def add(counts, batch):
        for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist()):
            if word == END:
                counts[END] += n
                counts[BLANK + END] += n
                continue
            line = BLANK + word + BLANK
            for i in range(1, len(line)):
                for begin in range(max(0, i - order), i + 1):
                    counts[line[begin:i + 1]] += n
    return counted(words, VOCABULARY, add)


def context_trie(grams: DataFrame, max_contexts: int) -> dict[bytes, tuple[bytes, list[int]]]:
    """Context to (symbols, counts), for the most frequent contexts. A shorter context is at least as frequent
    as a longer one that ends in it, so what is kept stays a trie."""
    nodes = written(grams.groupBy(F.substring("word", 1, F.octet_length("word") - 1).alias("context"))
                    .agg(F.sum("n").alias("total"),
                         F.collect_list(F.struct(F.expr("substring(word, -1, 1)").alias("symbol"), "n")).alias("next")),
                    "contexts")
    by_total = nodes.groupBy("total").count().orderBy(F.desc("total"))
    least, held = 1, 0
    for r in by_total.limit(max_contexts + 1).toLocalIterator():  # no more totals than contexts matter
        held += r["count"]
        if held > max_contexts:
            least = r["total"] + 1
            break
    return {bytes(r["context"]): (b"".join(bytes(x["symbol"]) for x in r["next"]), [x["n"] for x in r["next"]])
            for r in nodes.filter(F.col("total") >= least).toLocalIterator()}


class Scorer:
    """log10 probabilities of bytes and words under a trie."""

    def __init__(self, trie: dict, order: int):
        self.trie, self.order = trie, order

    def step(self, gram: bytes) -> float:
        """log10 P(last byte | the bytes before it)."""
        symbol, excluded, total = gram[-1], b"", 0.0
        for begin in range(len(gram)):
            node = self.trie.get(gram[begin:-1])
            if node is None:
                continue
            symbols, counts = node
            if excluded:
                left = [(s, n) for s, n in zip(symbols, counts) if s not in excluded]
                if not left:
                    continue
                room, own = 2 * sum(n for _, n in left), dict(left).get(symbol)
                kinds = len(left)
            else:
                at = symbols.find(symbol)
                room, own, kinds = 2 * sum(counts), counts[at] if at >= 0 else None, len(counts)
            if own is not None:
                return total + math.log10((2 * own - 1) / room)
            total += math.log10(kinds / room)
            excluded = symbols  # symbols of a longer context all follow the shorter one too
        return total - math.log10(max(1, 256 - len(excluded)))

    def word(self, word: bytes) -> float:
        line = BLANK + word + BLANK
        return sum(self.step(line[max(0, i - self.order):i + 1]) for i in range(1, len(line)))
