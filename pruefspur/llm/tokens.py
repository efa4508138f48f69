"""Token counts by offset-mapped attribution.

A document's fields are rendered to one string and encoded once.  The tokens' character spans are
merged with the spans of its sections, and a token that crosses a border is given to sections by a
stated rule.  The counts of the sections therefore add up to the tokens of the document.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranks of a public byte-level vocabulary, one ``base64 rank`` pair a line.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's own encoder cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A border-crossing token goes to the section of its first character, to the one that holds most
#: of it (the earlier one of equals), or to each by its share of the token's bytes.
RULES = ("first", "most", "share")
RULE = "most"
FIELDS = ("source", "lang")


@lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        ranks = {base64.b64decode(word): int(rank) for word, rank in pairs}
    widths = np.zeros(max(ranks.values()) + 1, np.int64)
    for word, rank in ranks.items():
        widths[rank] = len(word)
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), widths


#: White space as the pattern takes it, and the length of a run from which the encoder's own search for
#: its end may run out of stack.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 10_000


def token_ids(text: str, path: str = VOCABULARY, long_run: int = LONG_RUN) -> list[int]:
    """The tokens of a text.

    A long run of white space is cut out where the pattern cuts it in any case: it is one piece without its
    last character, which goes with what follows, or with it at the end of the text.  So the tokens are
    the same, and the pattern never has to search through the run."""
    encoder, _ = _encoder(path)
    out, at = [], 0
    for run in re.finditer(f"[{BLANKS}]{{{long_run},}}", text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        out += encoder.encode_ordinary(text[at : run.start()])
        out += encoder._encode_single_piece(text[run.start() : stop].encode())
        at = stop
    return out + encoder.encode_ordinary(text[at:])


def token_ends(text: str, path: str = VOCABULARY) -> np.ndarray:
    """The byte at which each token of a text ends."""
    _, widths = _encoder(path)
    return np.cumsum(widths[np.array(token_ids(text, path), np.int64)])


def attribute(ends: np.ndarray, borders: Sequence[int], rule: str = RULE) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of its tokens cross a border.

    ``ends`` are the tokens' last bytes (exclusive), ``borders`` the sections' (ascending, the last is
    the text's size).  Both ascend, so one merge of the two finds every overlap."""
    n = len(borders)
    stops = np.asarray(borders, np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(stops, starts, "right")
    last = np.searchsorted(stops, ends - 1, "right")
    crossing = first != last
    counts = np.bincount(first[~crossing], minlength=n).astype(float)
    crossed = np.zeros(n, np.int64)
    for t in np.flatnonzero(crossing):
        inside = range(int(first[t]), int(last[t]) + 1)
        lows = [max(starts[t], stops[s - 1] if s else 0) for s in inside]
        shares = [min(ends[t], stops[s]) - low for s, low in zip(inside, lows, strict=True)]
        crossed[[s for s, x in zip(inside, shares, strict=True) if x]] += 1
        if rule == "share":
            for s, x in zip(inside, shares, strict=True):
                counts[s] += x / (ends[t] - starts[t])
        elif rule == "most":
            counts[inside[int(np.argmax(shares))]] += 1
        else:
            counts[first[t]] += 1
    return counts, crossed


def sections_of(fields: Sequence[tuple[str, str | None]], text: str | None) -> tuple[str, list[tuple[str, int]]]:
    """The rendered document, and its sections in order with their characters: each field on a line
    of its own, a blank line, the text's first line, and the rest."""
    parts = [(name, f"{value or ''}\n") for name, value in fields]
    body = text or ""
    head, line_break, rest = body.partition("\n")
    parts += [("separator", "\n"), ("head", head + line_break), ("body", rest)]
    return "".join(p for _, p in parts), [(name, len(p)) for name, p in parts]


def _counted(path: str, rule: str, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, section, chars, tokens, crossed, total = [], [], [], [], [], []
            for i in range(batch.num_rows):
                fields = [(n, batch.column(2 + k)[i].as_py()) for k, n in enumerate(names)]
                whole, parts = sections_of(fields, batch.column(1)[i].as_py())
                ends = token_ends(whole, path)
                data = np.frombuffer(whole.encode("utf-8", "replace"), np.uint8)
                begins = np.flatnonzero((data & 0xC0) != 0x80)
                edge = np.append(begins, len(data))
                counts, over = attribute(ends, edge[np.cumsum([n for _, n in parts])], rule)
                for s, (name, n) in enumerate(parts):
                    ids.append(i)
                    section.append(name)
                    chars.append(n)
                    tokens.append(counts[s])
                    crossed.append(over[s])
                    total.append(len(ends))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(ids, pa.int64())),
                    pa.array(section, pa.string()),
                    pa.array(chars, pa.int64()),
                    pa.array(tokens, pa.float64()),
                    pa.array(crossed, pa.int64()),
                    pa.array(total, pa.int64()),
                ],
                names=["_id", "section", "n_chars", "n_tokens", "n_crossing", "doc_tokens"],
            )

    return run


def count(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fields: Sequence[str] = FIELDS,
    path: str = VOCABULARY,
    rule: str = RULE,
) -> DataFrame:
    """A row per document and section: the id, ``section``, ``n_chars``, ``n_tokens`` (whole numbers unless
    the rule is ``share``), ``n_crossing`` (tokens that are partly outside) and ``doc_tokens``.

    Sections are the fields, a separator, ``head`` (the text's first line) and ``body``.  A null field
    or text is an empty one and has no tokens of its own but its line break.  Repeated rows are counted each; a null id
    stays null.  Control strings in a text are ordinary text.  Other columns are not read.  No rows
    are exchanged; a task holds one batch of documents.  ``path`` is read by every task, so it names a
    place all of them have.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    if not path.startswith("/") or "\n" in path:
        path = os.path.abspath(path)
    work = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        *[F.col(c).cast("string").alias(f"_f{i}") for i, c in enumerate(fields)],
    )
    schema = f"_id {dict(work.dtypes)['_id']}, section string, n_chars bigint, n_tokens double, n_crossing bigint, doc_tokens bigint"
    return work.mapInArrow(_counted(path, rule, list(fields)), schema).withColumnRenamed("_id", id_col)
