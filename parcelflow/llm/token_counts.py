"""Exact token counts of every prefix of a text, by dynamic programming over the prefixes.

The vocabulary is a byte-pair encoding of lower-cased words with word ends (a tokenizers file). Within a word, a row of
tokens is what the merges make of it if and only if the merges leave every two neighbours apart. So the last token of
each prefix follows from those of shorter ones: it is the one token ending there that the merges keep apart from the last
token before it, and the prefix has one token more than the prefix in front of that token. Each prefix is also counted as a
whole word, its last byte bearing the word end, since that is what remains where a text is cut there.

Words between white space do not touch each other, so their counts are kept for the words met lately and added up over
whole texts with numpy. The table holds the count of every prefix of every text, in blocks of code points; how many tokens
a beginning has, where a budget ends and what fits are then asked of it with DataFrame functions, and nothing is encoded
again.
"""

from __future__ import annotations

import bisect
import functools
import json
import math
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, gives_back, row_hash

#: Tokens that a text may have in op13.
LIMIT = 2048
#: Code points whose counts stand in one row of the table.
BLOCK = 4096
#: Words that a worker remembers, twice: those met since the last change of generations, and those before.
REMEMBERED, LONGEST_REMEMBERED = 200_000, 64
#: Rows of the table that a worker remembers.
ROWS = 150_000
#: Tokens with a common beginning that are few enough to ask each whether it can follow.
FEW = 16
#: Characters with Unicode's property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE_SPACE = frozenset(re.findall(f"[{WHITE}]", "".join(map(chr, range(0x3001)))))
BEYOND_LATIN = re.compile("[^\\x00-\\xff]").search
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


class Generations(dict):
    """find(key) for every key, remembered for short keys that were asked for lately."""

    def __init__(self, find: Callable[[str], object], size: int = REMEMBERED):
        super().__init__()
        self.find, self.size, self.old = find, size, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.find(key)
            if len(key) > LONGEST_REMEMBERED:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


@functools.cache
def _joins_backwards() -> frozenset[str]:
    """Characters that composition may join to the one before them although they are no combining marks."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    seconds = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    return frozenset(seconds | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))})


def _sequences(text: str) -> Iterator[str]:
    """Parts of the text that composition treats each by itself."""
    start, backwards = 0, _joins_backwards()
    for i, c in enumerate(text):
        if i and not unicodedata.combining(c) and c not in backwards:
            yield text[start:i]
            start = i
    yield text[start:]


class PrefixCounter:
    """Counts of all prefixes of a text under one vocabulary file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        vocabulary, merges = told["model"]["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in told["model"]["merges"]]
        self.end = told["model"]["end_of_word_suffix"]
        self.special = [t["content"] for t in told["added_tokens"]]
        #: Tokens go by their names in the file, one character a byte.
        self.rank = {m: k for k, m in enumerate(merges)}
        self.made = {left + right: k for k, (left, right) in enumerate(merges)}
        self.halves = {left + right: (left, right) for left, right in merges}
        assert all(max(self.made.get(a, -1), self.made.get(b, -1)) < k for k, (a, b) in enumerate(merges)), "a merge comes before its parts"
        reachable = [t for t in vocabulary if t not in self.halves or self.apart(*self.halves[t], self.made[t])]
        self.plain = {t for t in reachable if not t.endswith(self.end)}
        self.ended = {t.removesuffix(self.end): t for t in reachable if t.endswith(self.end)}
        self.sorted = sorted(self.plain), sorted(self.ended)
        self.begun = {t[:k] for t in (*self.plain, *self.ended) for k in range(1, len(t))}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.restart()
        self.byte_names = _byte_names()
        # of characters that Python's Unicode does not know yet, the library itself says what they are to it
        found = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000)))))
        new, library = [c for c in found if unicodedata.category(c) == "Cn"], Tokenizer.from_file(path)
        self.later_lower = {ord(c): low for c in new if (low := library.normalizer.normalize_str(c)) != c}
        self.later_capitals = re.compile(f"[{''.join(map(chr, self.later_lower))}]" if self.later_lower else "(?!)").search
        marks = [ord(c) for c in new if len(library.pre_tokenizer.pre_tokenize_str("!" + c)) == 1]
        later = "".join(f"{a}-{b}" for a, b in _ranges(marks)) or "\0"
        letter, number = rf"[\p{{L}}--[{later}]]", rf"[\p{{N}}--[{later}]]"
        word = "|".join([f"{letter}+", number, *CONTRACTIONS, rf"[^{WHITE}{letter}{number}]+"])
        self.items = regex.compile(word, regex.V1).findall
        self.pieces = regex.compile(f"[{WHITE}]?(?:{word})|[{WHITE}]+", regex.V1).findall
        # the same for characters up to U+00FF, some two times as fast
        letters, numbers = ("".join(chr(c) for c in range(256) if unicodedata.category(chr(c))[0] == kind) for kind in "LN")
        white = "".join(sorted(c for c in WHITE_SPACE if c < "\u0100"))
        self.latin_pieces = re.compile(f"[{white}]?(?:[{letters}]+|[{numbers}]|{'|'.join(CONTRACTIONS)}|[^{white}{letters}{numbers}]+)|[{white}]+").findall
        self.chunks = re.compile(f"[{WHITE}]+|[^{WHITE}]+").findall
        self.specials = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        self.words = Generations(self.word_counts, REMEMBERED // 4)
        self.piece_steps = Generations(self.steps_of_piece)
        self.chunk_steps = Generations(self.steps_of_chunk, REMEMBERED // 4)

    def apart(self, a: str, b: str, top: float = math.inf) -> bool:
        """Whether merges earlier than `top` leave tokens a and b as they are when b follows a.

        What touches at the border is, at any time, a part of a's right edge and one of b's left edge; they are joined if a
        merge of the two comes before either is absorbed. Of equal merges the left one comes first. The edges are undone
        from the latest merge back.
        """
        until_a = until_b = top
        while True:
            r = self.rank.get((a, b))
            if r is not None and r < until_a and r <= until_b and r < top:
                return False
            made_a, made_b = self.made.get(a, -1), self.made.get(b, -1)
            if made_a == made_b == -1:
                return True
            if made_a > made_b:
                until_a, a = made_a, self.halves[a][1]
            else:
                until_b, b = made_b, self.halves[b][0]

    def follows(self, a: str, b: str) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= 2 * REMEMBERED:
                self.pairs.clear()
            known = self.pairs[a, b] = self.apart(a, b)
        return known

    def like(self, tail: str, before: str) -> str | None:
        """A token that the tokens which begin with tail, if they are few, can follow as they can follow `before`, the same
        for all such tokens, so that rows agree more often; None if none of them can follow."""
        known = self.likes.get((tail, before), self)
        if known is self:
            longer = []
            for names in self.sorted:
                low, high = bisect.bisect_right(names, tail), bisect.bisect_left(names, tail + chr(0x10FFFF))
                longer += [names] if high - low > FEW else names[low:high] if names is self.sorted[0] else [self.ended[t] for t in names[low:high]]
            known = before
            if len(longer) <= FEW and not any(isinstance(x, list) for x in longer):
                can = tuple(t for t in longer if not before or self.follows(before, t))
                known = self.classes.setdefault((tail, can), before) if can else None
            self.likes[tail, before] = known
        return known

    def step(self, state: int, char: str) -> tuple[int, int, int]:
        """One character on from a row of the table: (the row there, how many tokens more, how many more as a whole word).

        Of the prefixes so far, a row keeps those after which a longer token may still begin: the bytes since, the last
        token there, and how many tokens fewer it has.
        """
        row, total, ended = self.rows[state], 0, None
        names = [self.byte_names[b] for b in char.encode("utf-8")]
        for at, name in enumerate(names):
            last, count, longer = None, 0, []
            for since, before, fewer in row:
                tail = since + name
                if tail in self.plain and (not before or self.follows(before, tail)):
                    last, count = tail, total + 1 - fewer
                if at + 1 == len(names) and tail in self.ended and (not before or self.follows(before, self.ended[tail])):
                    ended = total + 1 - fewer
                if tail in self.begun:
                    longer.append((tail, before, fewer))
            if last is None:
                raise ValueError(f"no token ends with byte {name!r}")
            known = ((tail, self.like(tail, before), fewer + count - total) for tail, before, fewer in longer)
            row = (*(x for x in known if x[1] is not None), ("", last, 0))
            total = count
        if ended is None:
            raise ValueError(f"no token ends a word with {char!r}")
        to = self.numbers.get(row)
        if to is None:
            to = self.numbers[row] = len(self.rows)
            self.rows.append(row)
            self.steps.append({})
        self.steps[state][char] = made = (to, total, ended)
        return made

    def advance(self, text: str, state: int = 0, count: int = 0, out: list[int] | None = None) -> tuple[int, int]:
        """(row, count) after more of a word; the counts of its prefixes as whole words are added to out."""
        steps = self.steps
        for char in text:
            state, more, ended = steps[state].get(char) or self.step(state, char)
            if out is not None:
                out.append(count + ended)
            count += more
        return state, count

    def word_counts(self, word: str) -> list[int]:
        """Tokens of each prefix of a word of the pattern, by code points."""
        if len(self.rows) > ROWS:
            self.restart()
        out: list[int] = []
        self.advance(word, out=out)
        if word in CONTRACTIONS:  # cut short, it is an apostrophe and a word
            rest: list[int] = []
            self.advance(word[1:-1], out=rest)
            return [out[0], *(out[0] + n for n in rest), out[-1]]
        return out

    def restart(self) -> None:
        """Forget the rows met so far; the first one is that of no bytes."""
        first = (("", "", 0),)
        self.rows, self.numbers, self.steps = [first], {first: 0}, [{}]
        self.likes: dict[tuple[str, str], str | None] = {}
        self.classes: dict[tuple[str, tuple[str, ...]], str] = {}

    def lower(self, text: str) -> str:
        """Lower case, each character by itself: no final sigma."""
        if BEYOND_LATIN(text) and self.later_capitals(text):
            text = text.translate(self.later_lower)
        return text.lower() if "\u03a3" not in text else "".join(map(str.lower, text))

    def normal_counts(self, text: str) -> list[int]:
        """Tokens of each prefix of a composed, lower-cased text without white space."""
        out, base = [], 0
        for item in self.items(text):
            counts = self.words[item]
            out += [base + n for n in counts] if base else counts
            base = out[-1]
        return out

    def plain_counts(self, text: str) -> list[int]:
        """Tokens of each prefix of a text without white space, special tokens' strings counting as any other."""
        if unicodedata.is_normalized("NFC", text):
            lower = self.lower(text)
            counts = self.normal_counts(lower)
            if len(lower) == len(text):
                return counts
            return [counts[n - 1] for n in np.cumsum([len(self.lower(c)) for c in text])]
        whole = self.lower(unicodedata.normalize("NFC", text))
        items = self.items(whole)
        counts, out, at, item, begin = self.normal_counts(whole), [], 0, 0, 0
        starts = np.cumsum([0, *map(len, items)]).tolist()
        walked, state, count, ended = 0, 0, 0, [0]
        for part in _sequences(text):
            for k in range(1, len(part) + 1):
                normal = self.lower(unicodedata.normalize("NFC", part[:k]))
                if whole.startswith(normal, at):  # a prefix of the whole
                    out.append(counts[at + len(normal) - 1])
                    continue
                # not a prefix: what stood before it, from the start of the word, and then this
                while starts[item + 1] < at:
                    item += 1
                # an apostrophe by itself may yet become a contraction
                if (word := item - (item > 0 and items[item - 1] == "'")) is not None and starts[word] != begin or not walked:
                    begin = walked = starts[word]
                    state, count, ended = 0, 0, [0]
                state, count = self.advance(whole[walked:at], state, count, ended)
                walked, n = at, counts[begin - 1] if begin else 0
                first, *others = self.items(whole[begin:at] + normal)
                if len(first) >= at - begin and first not in CONTRACTIONS:
                    more = ended[-1:]
                    self.advance(first[at - begin :], state, count, more)
                    n += more[-1]
                else:
                    n += self.words[first][-1]
                out.append(n + sum(self.words[x][-1] for x in others))
            at += len(self.lower(unicodedata.normalize("NFC", part)))
        return out

    def steps_of_piece(self, piece: str) -> bytes:
        """Tokens of each prefix of white space, or of a word that one white space may precede, as unsigned 32-bit integers."""
        white = len(piece) if piece[-1] in WHITE_SPACE else int(piece[0] in WHITE_SPACE)
        return bytes(4 * white) + (np.array(self.words[piece[white:]], "<u4").tobytes() if white < len(piece) else b"")

    def steps_of_chunk(self, chunk: str) -> bytes:
        """Tokens of each prefix of white space or of a text without it, as unsigned 32-bit integers."""
        if chunk[0] in WHITE_SPACE:
            return bytes(4 * len(chunk))
        out, base, at = [], 0, 0
        for found in self.specials.finditer(chunk):
            # cut short, a special token is ordinary text that follows what stands before it
            before = self.plain_counts(chunk[at : found.end() - 1])
            out += [base + n for n in before]
            size = found.start() - at
            base += (before[size - 1] if size else 0) + 1
            out.append(base)
            at = found.end()
        if at < len(chunk):
            out += [base + n for n in self.plain_counts(chunk[at:])]
        return np.array(out, "<u4").tobytes()

    def counts(self, text: str) -> np.ndarray:
        """counts[i]: tokens of the first i + 1 code points of the text."""
        if not text:
            return np.zeros(0, np.int32)
        lower = self.lower(text)
        latin = not BEYOND_LATIN(text)
        if len(lower) == len(text) and (latin or unicodedata.is_normalized("NFC", text)) and not self.specials.search(text):
            steps = list(map(self.piece_steps.__getitem__, (self.latin_pieces if latin else self.pieces)(lower)))
        else:
            steps = list(map(self.chunk_steps.__getitem__, self.chunks(text)))
        sizes = np.fromiter(map(len, steps), np.int64, len(steps)) // 4
        within = np.frombuffer(b"".join(steps), "<u4").astype(np.int32)
        total = within[np.cumsum(sizes) - 1]
        return within + np.repeat(np.cumsum(total, dtype=np.int32) - total, sizes)


def _ranges(codes: list[int]) -> list[tuple[str, str]]:
    """First and last characters of the runs of ascending code points."""
    starts = [c for k, c in enumerate(codes) if not k or codes[k - 1] != c - 1]
    ends = [c for k, c in enumerate(codes) if k + 1 == len(codes) or codes[k + 1] != c + 1]
    return [(chr(a), chr(b)) for a, b in zip(starts, ends)]


def _byte_names() -> list[str]:
    """The character that stands for each byte in such files: itself if it is printable Latin-1, else the next from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


@functools.cache
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The table of prefix counts: doc_id, row, block, start, counts, last, n_bytes.

    counts[i] (from 0) is the number of tokens of the text's first start + i + 1 code points, cut there and encoded by
    itself. A text has a row for each `block` code points, so a very long one is many rows; its last row is marked, and
    n_bytes is the text's whole size. Null and empty texts have one row without counts. Rows of one id are told apart by
    `row`, a hash of id and text; wholly equal rows have equal rows here. Null ids are kept. Only the two named columns are
    read, so others may have any name. An empty table gives an empty one. No shuffle: each task counts the rows it reads.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("block", pa.int32()), ("start", pa.int64()), ("counts", pa.list_(pa.int32())), ("last", pa.bool_()), ("n_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = prefix_counter(vocabulary)
        for batch in batches:
            for low in range(0, len(batch), 100):
                part = batch.slice(low, 100)
                cols: list[list] = [[], [], [], [], [], [], []]
                for doc, row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()):
                    counts, n_bytes = own.counts(text), len(text.encode("utf-8"))
                    starts = range(0, max(1, len(counts)), block)
                    for k, start in enumerate(starts):
                        for col, x in zip(cols, (doc, row, k, start, counts[start : start + block], k + 1 == len(starts), n_bytes)):
                            col.append(x)
                sizes = np.cumsum([0, *map(len, cols[4])], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(cols[4])))
                yield pa.RecordBatch.from_arrays([lists if k == 4 else pa.array(c, t) for k, (c, t) in enumerate(zip(cols, schema.types))], schema=schema)

    texts = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), row_hash(id_col, text_col).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(gives_back(run), "doc_id long, row long, block int, start long, counts array<int>, last boolean, n_bytes long")


def _of_last(counts: Column) -> Column:
    return F.coalesce(F.try_element_at(counts, F.lit(-1)), F.lit(0)).cast("long")


def token_counts(table: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each text of a table of prefix counts: one row for each row of the documents,
    repeated ones too. Read off the texts' last prefixes, without a shuffle."""
    n = _of_last(F.col("counts"))
    return table.where("last").select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))


def longest_prefixes(table: DataFrame, budget: int) -> DataFrame:
    """doc_id, row, n_chars, n_tokens: the longest beginning of each text that has at most `budget` tokens, and its tokens.

    More characters can have fewer tokens, so every prefix is looked at, not only those before the first that is too long.
    Texts of which nothing fits, and empty ones, have 0 and 0. Equal rows of the documents give one row.
    """
    fits = F.transform("counts", lambda n: n <= budget)
    at = F.size("counts") - F.array_position(F.reverse(fits), True)  # of the last that fits
    best = F.when(F.array_contains(fits, True), F.struct((F.col("start") + at + 1).alias("n_chars"), F.get("counts", at.cast("int")).cast("long").alias("n_tokens")))
    found = table.groupBy("doc_id", "row").agg(F.max(best).alias("best"))
    return found.select("doc_id", "row", F.coalesce("best.n_chars", F.lit(0).cast("long")).alias("n_chars"), F.coalesce("best.n_tokens", F.lit(0).cast("long")).alias("n_tokens"))


def tokens_at(table: DataFrame, places: DataFrame, block: int = BLOCK) -> DataFrame:
    """places(doc_id, n_chars) with n_tokens, the tokens of the first n_chars code points of the text of that id.

    0 for no characters; null for an id that is not there, a null id, or more characters than the text has. An id with
    several texts gives a row for each. block must be that of the table.
    """
    asked = places.select("doc_id", F.col("n_chars").cast("long").alias("n_chars")).withColumn("block", F.floor((F.greatest("n_chars", F.lit(1)) - 1) / block).cast("int"))
    texts = table.select("doc_id", "row", "block", "start", "counts").distinct()
    n = F.when(F.col("n_chars") == 0, F.lit(0)).otherwise(F.get("counts", (F.col("n_chars") - F.col("start") - 1).cast("int"))).cast("long")
    found = asked.join(texts, ["doc_id", "block"], "left")
    return found.select("doc_id", "n_chars", F.when(F.col("row").isNotNull(), n).alias("n_tokens"))
