"""SentencePiece encoding of merge-type models by a table of prefixes, and decoding.

Merging always takes the best-scored pair of neighbours, the leftmost of equal
ones. A boundary that no merge crosses therefore splits the work in two, and a
sequence of tokens is the encoding of its text if and only if each token and
each pair of neighbours is the encoding of its own text. So every prefix of a
text has one last token: among the vocabulary entries that end there, found by
an automaton, the one that is compatible with the last token of the prefix
before it. The ids are recovered from the end backwards.

Pieces of these models never hold a blank after another character, so a text
is encoded by blank-separated units. Characters that no piece covers become
their UTF-8 bytes. The model must normalise by identity, with a leading blank
added and blanks kept; any other is refused.

Defined results: null or empty text has no ids and decodes to an empty text;
rows with equal ids are separate rows; an empty table gives an empty result;
other columns do not matter.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siltstone.llm.units import ByteTable, UnitTable, parts_by_size
from siltstone.session import ship_package

# Fixed value: the sign that stands for a blank in pieces.
BLANK = "▁"
# A text's units where blanks may stand together or at its end.
UNITS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
# Distinct units from which a generation of remembered ones is full.
MOST_UNITS = 1 << 18
# Pairs of tokens whose compatibility a task remembers.
MOST_PAIRS = 1 << 20
# Probe texts that a model with identity normalisation, a leading blank and kept blanks encodes without loss.
PROBES = (" two  blanks ", "ﬁ Å Å 　\t\n")

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceModel:
    """Vocabulary of a merge-type model with its prefix tables."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for probe in PROBES:
            if model.decode(model.encode(probe)) != probe:
                raise ValueError("the model changes texts before encoding them")
        self.scores: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_id = [0] * 256
        spoken: list[bytes] = []
        self.opens_blank = np.zeros(model.vocab_size(), bool)
        automaton = ahocorasick.Automaton()
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_id[value] = i
                spoken.append(bytes([value]))
            elif model.is_control(i):
                spoken.append(b"")
            elif model.is_unknown(i):
                spoken.append(" ⁇ ".encode())
            else:
                if BLANK in piece.lstrip(BLANK):
                    raise ValueError("a piece holds a blank after another character")
                self.scores[piece], self.id_of[piece] = model.get_score(i), i
                automaton.add_word(piece, (piece, len(piece)))
                spoken.append(piece.replace(BLANK, " ").encode())
                self.opens_blank[i] = piece[0] == BLANK
        automaton.make_automaton()
        self.automaton = automaton
        # By token, and for an empty text: the tokens tried after it, and whether they are compatible.
        self.after: dict[str, dict[str, bool]] = {piece: {} for piece in ("", *self.scores)}
        self.known_pairs = 0
        self.spoken = ByteTable(spoken)
        self.numbers = ByteTable([b"%d," % i for i in range(model.vocab_size())])
        self.table = UnitTable(lambda units: [self.unit_ids(u) for u in units], MOST_UNITS)

    def merged(self, text: str) -> list[str]:
        """Tokens of a short text by the merging rule itself."""
        symbols = list(text)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def compatible(self, before: str, token: str) -> bool:
        """Whether the two tokens, or the token alone after an empty text, are the encoding of their text."""
        if self.known_pairs > MOST_PAIRS:
            for known in self.after.values():
                known.clear()
            self.known_pairs = 0
        fits = self.merged(before + token) == ([before, token] if before else [token])
        self.after[before][token] = fits
        self.known_pairs += 1
        return fits

    def last_tokens(self, text: str) -> list[str | None]:
        """The last token of the encoding of every prefix, by its length; None for a character that no piece covers.

        The automaton reports the pieces that end at a place longest first, place by place.
        """
        last: list[str | None] = [None] * (len(text) + 1)
        last[0] = ""
        tried: list[dict | None] = [None] * (len(text) + 1)  # pairs known of the last token
        tried[0] = self.after[""]
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end] is not None:
                continue
            at = end - length
            pairs = tried[at]
            if pairs is None:
                pairs = tried[at] = self.after.setdefault(text[at - 1], {})
            fits = pairs.get(token)
            if fits is None:
                fits = self.compatible(text[at - 1] if last[at] is None else last[at], token)
            if fits:
                last[end], tried[end] = token, self.after[token]
        return last

    def unit_ids(self, unit: str) -> list[int]:
        last = self.last_tokens(unit)
        at, backwards = len(unit), []
        while at:
            token = last[at]
            if token is None:
                at -= 1
                backwards += [self.byte_id[b] for b in reversed(unit[at].encode())]
            else:
                at -= len(token)
                backwards.append(self.id_of[token])
        return backwards[::-1]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of whole texts. With a blank before it and for every blank in it, a text is a row of units."""
        marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(BLANK, pc.replace_substring(texts, " ", BLANK), ""))
        single = pc.invert(pc.match_substring_regex(marked, f"{BLANK}{BLANK}|{BLANK}$|^$"))
        # Where blanks stand alone, units are what lies between them, but for the blank that each begins with.
        units = pc.split_pattern(pc.utf8_slice_codeunits(marked, 1), BLANK)
        if pc.all(single).as_py() is not False:
            return self.table.encode(pa.ListArray.from_arrays(units.offsets, pc.binary_join_element_wise(BLANK, units.values, "")))
        parted = [
            [BLANK + w for w in words] if alone else UNITS.findall(text)
            for text, words, alone in zip(marked.to_pylist(), units.to_pylist(), single.to_pylist())
        ]
        return self.table.encode(pa.array(parted, pa.list_(pa.string())))

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids: blanks for their sign, without the leading one; each wrong byte becomes U+FFFD."""
        silent = np.flatnonzero(self.spoken.lengths[ids] == 0)
        spoken = np.delete(ids, silent)
        # A control id ends a run of bytes.
        runs = np.split(spoken, np.unique(silent - np.arange(len(silent)))) if len(silent) else [ids]
        text = "".join(self.spoken.write(run).decode("utf-8", "each-byte") for run in runs)
        return text[1:] if len(spoken) and self.opens_blank[spoken[0]] else text

    def listed(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return self.numbers.write(ids)[:-1]


@lru_cache(maxsize=1)
def piece_model(path: str) -> PieceModel:
    """The model of this process: later tasks find the units that earlier ones have met."""
    return PieceModel(path)


def encode_texts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids."""
    return _each_text(docs, model, lambda m, ids: (ids,), [T.StructField("ids", T.ArrayType(T.IntegerType()))])


def decode_ids(rows: DataFrame, model: str, column: str = "ids") -> DataFrame:
    """The rows with the texts of their ids in place of the ids; null ids count as none."""
    schema = T.StructType([f for f in rows.schema.fields if f.name != column] + [T.StructField("text", T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in batches:
            texts = [pieces.decode(np.array(x.as_py() or [], np.int32)) for x in batch.column(column)]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(schema.names[:-1]).columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(decode, schema)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text is encoded, and its ids decoded again."""
    ship_package(docs.sparkSession)

    def digests(m: PieceModel, ids: np.ndarray) -> tuple:
        return len(ids), hashlib.sha256(m.listed(ids)).hexdigest(), hashlib.sha256(m.decode(ids).encode()).hexdigest()

    return _each_text(docs, model, digests, [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])


def _each_text(docs: DataFrame, model: str, result, fields: list[T.StructField]) -> DataFrame:
    schema = T.StructType([docs.schema["doc_id"], *fields])
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in batches:
            for first, last in parts_by_size(batch.column("text")):
                part = batch.slice(first, last - first)
                found = [result(pieces, ids) for ids in pieces.encode(part.column("text").fill_null(""))]
                columns = [pa.array(values, kind) for values, kind in zip(zip(*found), types)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
