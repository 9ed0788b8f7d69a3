"""Token counts by a public tokenizer's file, exact on whole texts.

Texts are cut at safe boundaries, where no token of the tokenizer can cross and nothing on one side changes the tokens on
the other. The pieces are encoded in batches of equal bytes, each short one once, and only their lengths are kept.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.rows import distinct_name

BATCH = 1 << 22  # characters that are encoded together
LONG = 1 << 12  # characters of a piece from which it is also cut between letters and digits
SHORT, KNOWN = 32, 400_000  # a Python worker remembers the lengths of pieces of SHORT characters at most
FILE = 1 << 26  # most bytes of a tokenizer's file, which goes to every task
LIMIT = 1024  # tokens above which a document is over the limit

SPACES = " \t\r\n"
ODD_SPACE = re.compile(r"[^\S \t\r\n]")  # white space, by Python, other than SPACES
PIECE = re.compile(rf"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
BEFORE_SPACE = re.compile(rf"(?<=\S)(?=[{SPACES}])")
KIND_CHANGE = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


def pieces(text: str) -> list[str]:
    """A text cut where a space follows something else; very long pieces also between an ASCII letter and a digit.

    Byte-level BPE first cuts a text into runs of letters, digits, or other characters, each with one space in front at
    most, and into white space. So a run ends at every such boundary, and what follows starts afresh.
    """
    found = BEFORE_SPACE.split(text) if ODD_SPACE.search(text) else PIECE.findall(text)
    if len(text) > LONG and any(len(p) > LONG for p in found):
        found = [q for p in found for q in (KIND_CHANGE.split(p) if len(p) > LONG else (p,))]
    return found


def separable(kind: str, content: bytes) -> bool:
    """Whether ``pieces`` is safe: byte-level BPE with its usual pattern, and no added token that a cut could hurt."""
    if kind != "json":
        return False
    made = json.loads(content)
    first, model = made.get("pre_tokenizer") or {}, made["model"]
    plain = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space", True)
    plain = plain and made.get("normalizer") is None and model.get("type") == "BPE" and not model.get("dropout")
    cut = lambda a: any(p.search(a["content"]) for p in (re.compile(r"\s"), KIND_CHANGE))
    return bool(plain) and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or cut(a) for a in made.get("added_tokens", ()))


def encoder(kind: str, content: bytes) -> Callable[[list[str]], list[int]]:
    """Texts to their numbers of tokens, as the file's library gives them, without begin, end, truncation or padding."""
    if kind == "json":
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(content.decode())
        made.no_truncation()
        made.no_padding()
        return lambda texts: [len(e) for e in made.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=content)
    return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]


def balanced(texts: list[str], most: int = BATCH) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``most`` characters; a longer text is a list of its own."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


class Counter:
    """Counts tokens of texts; remembers short pieces of late, up to twice KNOWN of them."""

    def __init__(self, kind: str, content: bytes) -> None:
        self.encode, self.cut = encoder(kind, content), separable(kind, content)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def lengths(self, texts: list[str]) -> list[int]:
        return [n for part in balanced(texts) for n in self.encode(part)]

    def distinct(self, found: set[str]) -> dict[str, int]:
        """The lengths of different pieces; those that are not remembered are encoded together."""
        if len(self.young) > KNOWN:
            self.young, self.old = {}, self.young
        own = {p: self.young.get(p) or self.old.get(p) for p in found}
        new = [p for p, n in own.items() if n is None]
        own.update(zip(new, self.lengths(new)))
        self.young.update((p, n) for p, n in own.items() if len(p) <= SHORT)
        return own

    def counts(self, texts: list[str]) -> list[int]:
        if not self.cut:
            return self.lengths(texts)
        out = []
        for part in balanced(texts):
            split = [pieces(t) for t in part]
            own = self.distinct(set().union(*split))
            out += [sum(map(own.__getitem__, found)) for found in split]
        return out


_counters: dict[str, Counter] = {}  # of this Python worker


def with_counts(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with ``n_tokens`` (long): tokens of each whole text by the tokenizer file at ``path``.

    ``path`` is read on the driver: a ``.json`` file for tokenizers or a ``.model`` file for sentencepiece, of FILE
    bytes at most, which are broadcast. Byte-level BPE files are counted by pieces, all others by whole texts. Null and
    empty texts have 0 tokens, repeated rows each their own count. There is no shuffle: a task counts the rows that it
    reads, a long text piece by piece. A column of that name is replaced.
    """
    kind, content = Path(path).suffix[1:], Path(path).read_bytes()
    if kind not in ("json", "model"):
        raise ValueError("a tokenizer is a .json or .model file")
    if len(content) > FILE:
        raise ValueError(f"the tokenizer's file is larger than {FILE} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(content)
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    body = distinct_name(docs, "_body")
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add(name, "long")
    wanted = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(text), F.lit("")).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = f"{kind}:{len(sent.value)}:{hash(sent.value)}"
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter(kind, sent.value)
        counter = _counters[key]
        for batch in batches:
            made = counter.counts(batch.column(len(kept)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.int64())], names=[*kept, name])

    return wanted.mapInArrow(run, schema)


def over(tokens: Column, limit: int = LIMIT) -> Column:
    return tokens > limit
