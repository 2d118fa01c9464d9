"""Token counts with a whole-token shortcut.

Offline, ``prove_whole_tokens`` runs the tokenizer's own model over every string of its vocabulary and
keeps those that come back as exactly one token, themselves. Online, a text is cut into units at ASCII
white space and after its leading letters, a unit is normalised and split into pre-tokens by the tokenizer's
own rules, pre-tokens in the proved set count one, and only the others are merged. Words seen before are looked up.

Cutting there is exact for tokenizers whose pre-tokens hold no white space and split letters from other
characters, and whose added tokens hold no white space; ``WholeTokenCounter`` tries this out when it is made, and
otherwise counts each text whole.

Null and empty texts have no tokens. Texts are counted whole, however long. Repeated rows and ties do
not matter: every row is counted by itself. An empty table gives no rows. Only the id and the text column are read, so other
columns cannot clash.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytelevel import leading_run, spell
from millrace.llm.memory import remembers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = leading_run()
# Units kept per Python worker; beyond that the memory is cleared and filled anew.
MEMORY_UNITS = 1_000_000
MEMORY_CHARS = 64


def prove_whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings (in the model's own alphabet) that the model leaves as one token."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        suffix = json.load(file)["model"].get("end_of_word_suffix") or ""
    proved = set()
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        piece = entry.removesuffix(suffix) if suffix else entry
        if suffix and not entry.endswith(suffix):
            continue
        if piece and [t.id for t in tokenizer.model.tokenize(piece)] == [number]:
            proved.add(piece)
    return frozenset(proved)


class WholeTokenCounter(dict):
    """Word -> number of tokens, filled on demand; ``count`` adds up a text."""

    def __init__(self, path: str, proved: frozenset[str]):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.proved = proved
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        probe = self.tokenizer.pre_tokenizer.pre_tokenize_str("ab c  1 d.\te,-\nf' g(") if self.tokenizer.pre_tokenizer else []
        self.lower = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("aBZ") == "abz"
        self.cuts = (
            [t for t, _ in probe] == ["ab", "c", "1", "d", ".", "e", ",-", "f", "'", "g", "("]
            and all(WORD.fullmatch(a) and not a[0].isalpha() for a in self.added)
        )

    def __missing__(self, chunk: str) -> int:
        number = sum(map(self.measure, WORD.findall(chunk)))
        if len(chunk) <= MEMORY_CHARS:
            if len(self) >= MEMORY_UNITS:
                self.clear()
            self[chunk] = number
        return number

    def pre_token(self, piece: str) -> int:
        return 1 if piece in self.proved else len(self.tokenizer.model.tokenize(piece))

    def measure(self, word: str) -> int:
        run = LETTERS.match(word) if self.lower else None
        if run is not None:
            rest = word[run.end() :]
            return self.pre_token(spell(run[0].lower())) + (self.measure(rest) if rest else 0)
        if any(a in word for a in self.added):
            return len(self.tokenizer.encode(word, add_special_tokens=False))
        normal = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        return sum(self.pre_token(piece) for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.cuts:
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        return sum(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=1)
def whole_token_counter(path: str, proved: frozenset[str]) -> WholeTokenCounter:
    """One per Python worker, which keeps its memory from task to task."""
    return WholeTokenCounter(path, proved)


remembers("token_counts", whole_token_counter.cache_clear)


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit. ``tokenizer`` is the path of a tokenizers file on every machine.

    The proved set is bounded by the vocabulary and sent once to each executor.
    """
    proved = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(tokenizer))

    @F.pandas_udf("bigint")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = whole_token_counter(tokenizer, proved.value)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(F.col(id_col), F.octet_length(text).cast("bigint").alias("n_bytes"), tokens(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
