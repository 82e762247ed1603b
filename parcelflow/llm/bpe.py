"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

The nondeterministic transducer reads bytes and guesses where tokens end: a configuration is (last token, node in the
trie of tokens, tokens not yet written). A guess survives only if the new token can stand after the last one, that is,
if merging the bytes of the two gives just these two; BPE output is exactly the one sequence whose neighbours all agree
so. Determinisation keeps the set of live configurations as one state and writes the tokens that all of them share;
as every guess ends within the longest token, lookahead is bounded. States and transitions are made when first needed.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import gives_back, id_text

#: Bounds of the caches of one worker: transducer states, pairs of tokens, and whole pre-tokens. A full cache restarts.
MAX_STATES, MAX_PAIRS, MAX_WORDS = 450_000, 800_000, 700_000
#: Above every rank.
NEVER = 1 << 40


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.next: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for token, i in ranks.items():
            node = 0
            for b in token:
                to = self.next[node].get(b)
                if to is None:
                    to = self.next[node][b] = len(self.next)
                    self.next.append({})
                    self.token_at.append(-1)
                node = to
            self.token_at[node] = i
        self.agree: dict[int, bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, int, bytes]]] = {}
        self.restart()

    def restart(self) -> None:
        start = ((-1, 0, ()),)
        self.known = {start: 0}
        self.states = [start]
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def merged(self, text: bytes, down_to: int = 1) -> list[int]:
        """BPE by its definition, for the few bytes of a token, until `down_to` parts are left."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > down_to:
            best, i = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def spine(self, token: int, side: int) -> list[tuple[int, int, bytes]]:
        """The parts that stand at the token's right (1) or left (0) end as it is merged, each until a rank: (rank at
        which it is there, rank at which it becomes part of the next, bytes)."""
        found = self.spines.get((token, side))
        if found is None:
            found, at, until = [], token, NEVER
            while True:
                text = self.bytes_of[at]
                found.append((at if len(text) > 1 else -1, until, text))
                if len(text) == 1:
                    break
                until, at = at, self.merged(text, 2)[-side]
            self.spines[token, side] = found
        return found

    def may_follow(self, last: int, token: int) -> bool:
        """Whether merging never crosses from last into token: no two parts that are there at one time have a merge
        that comes before their own next ones. The left one of two equal merges comes first."""
        key = last * 65536 + token
        ok = self.agree.get(key)
        if ok is None:
            if len(self.agree) >= MAX_PAIRS:
                self.agree.clear()
            if last < 0:
                ok = self.merged(self.bytes_of[token]) == [token]
            else:
                ok, rank = True, self.ranks.get
                right = self.spine(token, 0)
                for since, until, left in self.spine(last, 1):
                    for since_r, until_r, part in right:
                        if until > since_r and until_r >= since and (m := rank(left + part, NEVER)) < until and m <= until_r:
                            ok = False
                            break
                    if not ok:
                        break
            self.agree[key] = ok
        return ok

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The transition, made now: next state and the tokens that are certain."""
        live, following, token_at = [], self.next, self.token_at
        for last, node, waiting in self.states[state]:
            to = following[node].get(byte)
            if to is not None:
                token = token_at[to]
                if token >= 0 and self.may_follow(last, token):
                    live.append((token, 0, (*waiting, token)))
                if following[to]:
                    live.append((last, to, waiting))
        sure = live[0][2]
        for _, _, waiting in live:
            if waiting[: len(sure)] != sure:
                sure = sure[: next((i for i, (a, b) in enumerate(zip(sure, waiting)) if a != b), min(len(sure), len(waiting)))]
            if not sure:
                break
        if n := len(sure):
            live = [(last, node, w[n:]) for last, node, w in live]
        key = tuple(live)
        to = self.known.get(key)
        if to is None:
            to = self.known[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        made = self.steps[state][byte] = (to, sure)
        return made

    def encode(self, text: bytes) -> list[int]:
        """Token ids of one pre-token."""
        if len(self.states) > MAX_STATES:
            self.restart()
        out: list[int] = []
        state, steps = 0, self.steps
        for byte in text:
            made = steps[state].get(byte)
            if made is None:
                made = self.step(state, byte)
            state = made[0]
            if made[1]:
                out += made[1]
        out += next(w for _, node, w in self.states[state] if node == 0)
        return out


class Utf8Stream:
    """Incremental decoding: a state machine over the last bytes says how many of them begin a character that is not
    yet whole; these wait for the next call. Bytes that no character can contain become U+FFFD, as in Python."""

    def __init__(self) -> None:
        self.waiting = b""

    @staticmethod
    def open_tail(data: bytes) -> int:
        """How many bytes at the end are a proper beginning of a character."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue  # inside a character; its first byte stands further left
            need = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1
            if back >= need:
                return 0
            if back > 1:  # the second byte has a narrower range after these
                low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
                if not low <= data[1 - back] <= high:
                    return 0
            return back
        return 0

    def feed(self, data: bytes, final: bool = False) -> str:
        data = self.waiting + data
        hold = 0 if final else self.open_tail(data)
        self.waiting = data[len(data) - hold :]
        return data[: len(data) - hold].decode("utf-8", "replace")


class Codec:
    """Encoding of whole texts: the pattern splits them, the transducer encodes each piece not met lately."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fst = Transducer(ranks)
        # \s as in Unicode's White_Space, which lacks the separators 1C to 1F
        space = r"[\t-\r \x85\xa0  -     　]"
        pattern = public_tokenizers.PATTERN.replace(r"[^\s", "[^" + space[1:-1]).replace(r"\S", "[^" + space[1:]).replace(r"\s", space)
        self.split = regex.compile(pattern).findall
        self.bytes_of = [self.fst.bytes_of.get(i, b"") for i in range(max(ranks.values()) + 1)]
        self.packed: dict[str, bytes] = {}

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        packed, out = self.packed, []
        for word in self.split(text):
            ids = packed.get(word)
            if ids is None:
                found = self.fst.encode(word.encode("utf-8"))
                ids = struct.pack(f"<{len(found)}I", *found)
                if len(word) <= 64:
                    if len(packed) >= MAX_WORDS:
                        packed.clear()
                    packed[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: Iterable[int], chunk: int = 65536) -> Iterator[str]:
        """Text in parts, as ids come."""
        stream, ids, of = Utf8Stream(), iter(ids), self.bytes_of.__getitem__
        while part := b"".join(map(of, itertools.islice(ids, chunk))):
            yield stream.feed(part)
        yield stream.feed(b"", final=True)


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with_ids the ids as an array.

    Null and empty texts have no tokens and the digests of no bytes. Ids may be null or repeated; every row is encoded.
    Only doc_id and text are read. No shuffle: each task encodes the rows it reads, with bounded caches.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            n, ids_sha, text_sha, all_ids = [], [], [], []
            for text in batch.column(1):
                packed = own.encode_packed(text.as_py())
                ids = np.frombuffer(packed, "<u4").tolist()
                decoded = hashlib.sha256()
                for part in own.decode(ids):
                    decoded.update(part.encode("utf-8"))
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                text_sha.append(decoded.hexdigest())
                all_ids.append(ids if with_ids else None)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(all_ids, pa.list_(pa.int64()))] * with_ids, schema=schema)

    return id_text(docs).mapInArrow(gives_back(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids)
