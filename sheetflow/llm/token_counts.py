"""Token counts with a whole-token shortcut.

A byte-level BPE vocabulary is checked once, offline: which of its strings does
the tokenizer encode alone as one token? A pre-token that is one of these counts
as 1 without any merging; only the rest goes through the merges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetflow.llm.common import PLAIN_LETTERS, keyed_text, per_text, worker_memo

# The pre-token pattern of the vocabulary file: a fixed value of its format.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Texts in which no white space touches a blank, made of characters whose class
# is beyond doubt: they fall apart at blanks, for a blank starts a pre-token.
HARD = re.compile(rf"[ \n] | \n|^ |[^\n -~{PLAIN_LETTERS}¡¿]")

# Entries that a worker keeps before it starts afresh.
MEMO_SIZE = 600_000


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write each byte: printable ones as themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that the tokenizer encodes, alone, as exactly that one token."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    back = {c: b for b, c in byte_letters().items()}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    written, ids = [], []
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        if token in special or any(c not in back for c in token):
            continue
        try:
            written.append(bytes(back[c] for c in token).decode())
            ids.append(i)
        except UnicodeDecodeError:
            continue
    encoded = tokenizer.encode_batch(written, add_special_tokens=False)
    return [s for s, i, e in zip(written, ids, encoded, strict=True) if e.ids == [i]]


class Counter:
    """Counts tokens of texts inside a task."""

    def __init__(self, path: str, whole: list[str]):
        import regex
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.merge, self.pre = tokenizer.model.tokenize, tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.whole = frozenset(whole)
        self.letters = byte_letters()
        self.find = regex.compile(PRE_TOKEN).findall
        self.chunks, self.rest = worker_memo(f"chunks {path}"), worker_memo(f"rest {path}")

    def pre_token(self, s: str) -> int:
        if s in self.whole:
            return 1
        n = self.rest.get(s)
        if n is None:
            if len(self.rest) > MEMO_SIZE:
                self.rest.clear()
            n = self.rest[s] = len(self.merge(s.encode().decode("latin-1").translate(self.letters)))
        return n

    def chunk(self, s: str) -> int:
        """What stands between two blanks, with the blank before it."""
        if s[1:].isalpha():
            return self.pre_token(s)
        if s[1:-1].isalpha() and s[-1] in ".,":
            return self.pre_token(s[:-1]) + self.pre_token(s[-1])
        return sum(map(self.pre_token, self.find(s)))

    def hard(self, text: str) -> int:
        """Any text: special strings first, then the library's own pre-tokens."""
        n, at = 0, 0
        for m in self.at_special.finditer(text) if self.at_special else ():
            n += 1 + self.segment(text[at : m.start()])
            at = m.end()
        return n + self.segment(text[at:])

    def segment(self, text: str) -> int:
        merge, whole, back = self.merge, self.whole, {c: b for b, c in self.letters.items()}
        n = 0
        for written, _ in self.pre(text) if text else ():
            try:
                s = bytes(back[c] for c in written).decode()
            except UnicodeDecodeError:
                s = None
            n += 1 if s in whole else len(merge(written))
        return n

    def text(self, text: str) -> int:
        if not text:
            return 0
        if HARD.search(text) or text[-1] in " \n" or (self.at_special and "<" in text and self.at_special.search(text)):
            return self.hard(text)
        first, *others = text.split(" ")
        known = self.chunks
        try:
            n = sum(map(known.__getitem__, others))
        except KeyError:
            if len(known) > MEMO_SIZE:
                known.clear()
            for s in set(others):
                if s not in known:
                    known[s] = self.chunk(" " + s)
            n = sum(map(known.__getitem__, others))
        return n + sum(map(self.pre_token, self.find(first)))


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """Key, n_bytes, n_tokens and over_limit of every row, as the tokenizer file gives them.

    Special strings inside a text count as the library counts them by default;
    nothing is added, cut or padded. A null text counts as empty (0 tokens), a
    null or repeated key keeps its row, other columns of ``docs`` are ignored,
    whatever their names. No shuffle: each text is counted where it is read.
    The vocabulary check runs on the driver; its list is bounded by the
    vocabulary and broadcast.
    """
    spark = docs.sparkSession
    shortcut = spark.sparkContext.broadcast(whole_tokens(tokenizer))

    def work(pairs) -> Iterator[dict[str, list]]:
        counter = Counter(tokenizer, shortcut.value)
        for keys, texts in pairs:
            yield {
                "key": keys,
                "n_bytes": [len(t.encode()) if t else 0 for t in texts],
                "n_tokens": [counter.text(t) if t else 0 for t in texts],
            }

    rows = keyed_text(docs, key, text)
    kind = dict(rows.dtypes)["key"]
    counted = per_text(rows, work, f"key {_arrow_kind(kind)}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("key").cast(kind).alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _arrow_kind(kind: str) -> str:
    return {"bigint": "long", "int": "int", "string": "string"}[kind]
