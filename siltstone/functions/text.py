"""String, hash, URL, JSON and chunking functions. All but the n-th match stay in the JVM."""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: surrogate keys must equal those already stored elsewhere.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Fixed value: the signs a regular expression counts as white space.
WHITE_SPACE = " \t\n\x0b\f\r"

# URL prefixes dropped before the host or path is cut out.
HOST_PREFIXES = ("android-app://", "http://", "https://")
PATH_PREFIXES = ("http://", "https://")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_space(c: Column | str) -> Column:
    """Strip every kind of leading and trailing white space (``trim`` strips blanks only)."""
    return F.btrim(as_col(c), F.lit(WHITE_SPACE))


def content_hash(c: Column | str) -> Column:
    """Upper-case hex SHA-256 of the trimmed, lower-cased text."""
    return F.upper(F.sha2(F.lower(trim_space(c)), 256))


def surrogate_key(cols: Sequence[str], nulls_as_empty: bool = False) -> Column:
    """md5 over the columns as text, joined by ``-``."""
    if isinstance(cols, str):
        raise TypeError("surrogate_key takes a list of column names")
    stand_in = F.lit("" if nulls_as_empty else NULL_KEY_PART)
    return F.md5(F.concat_ws("-", *[F.coalesce(as_col(c).cast("string"), stand_in) for c in cols]))


def md5_hex(c: Column | str) -> Column:
    return F.md5(as_col(c).cast("string"))


def _drop_all(c: Column, needles: Sequence[str]) -> Column:
    return reduce(lambda acc, n: F.replace(acc, F.lit(n), F.lit("")), needles, c)


def url_host(c: Column | str) -> Column:
    """Host of a URL, with or without a scheme."""
    bare = _drop_all(as_col(c), HOST_PREFIXES)
    return F.split_part(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(c: Column | str) -> Column:
    """Path of a URL without the leading slash and without the query string."""
    bare = _drop_all(as_col(c), PATH_PREFIXES)
    slash = F.locate("/", bare)
    query = F.locate("?", bare)
    cut = F.when(slash > 0, slash).otherwise(query - 1)
    rest = F.when(F.length(bare) > cut, F.substr(bare, cut + 1)).otherwise(F.lit(""))
    return F.split_part(rest, F.lit("?"), F.lit(1))


def url_parameter(c: Column | str, name: str) -> Column:
    """Value of a query parameter, NULL when absent or empty."""
    tail = F.split_part(as_col(c), F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(tail, F.lit("&"), F.lit(1)), F.lit(""))


def match_position(
    c: Column | str, pattern: str, position: int = 1, occurrence: int = 1, flags: str = ""
) -> Column:
    """1-based start of the n-th match at or after ``position``; 0 when there is none.

    Matches are found in the uncut text, so anchors and look-behind see what
    stands before ``position``. Spark's own function gives the first match; it
    has no other, so further ones come from a vectorised function.
    """
    regex = F.lit(f"(?{flags}){pattern}" if flags else pattern)
    text = as_col(c)
    if position == 1 and occurrence == 1:
        return F.regexp_instr(text, regex)

    compiled = re.compile(f"(?{flags}){pattern}" if flags else pattern)

    @F.arrow_udf("int")
    def nth(texts: pa.Array) -> pa.Array:
        def start(value: str) -> int:
            found = compiled.finditer(value, position - 1)
            hit = next(itertools.islice(found, occurrence - 1, None), None)
            return hit.start() + 1 if hit else 0

        return pa.array([None if v is None else start(v) for v in texts.to_pylist()], pa.int32())

    return nth(text)


def word_count(c: Column | str) -> Column:
    """Number of pieces between single blanks, empty pieces included; no pieces are made."""
    text = as_col(c)
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def chunk_count(c: Column | str, size: int, overlap: int = 0) -> Column:
    """Number of chunks of ``size`` characters stepping by ``size - overlap``, at least one."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be between 0 and size - 1")
    beyond_first = F.greatest(F.length(as_col(c)) - F.lit(overlap), F.lit(1))
    return F.greatest(F.ceil(beyond_first / F.lit(size - overlap)), F.lit(1)).cast("int")


def chunk_at(c: Column | str, index: Column, size: int, overlap: int = 0) -> Column:
    """The chunk with the given 1-based index."""
    return F.substr(as_col(c), (index - 1) * F.lit(size - overlap) + 1, F.lit(size))


def parse_metadata(c: Column | str) -> Column:
    """JSON object text as ``map<string,string>``; other text is kept under the key ``raw``."""
    text = as_col(c)
    parsed = F.from_json(text, "map<string,string>")
    is_object = F.try_parse_json(text).isNotNull() & F.ltrim(text).startswith("{")
    return F.when(text.isNotNull(), F.when(is_object, parsed).otherwise(F.create_map(F.lit("raw"), text)))


def normalise_metadata(c: Column | str) -> Column:
    """Text that is always valid JSON: NULL becomes ``{}``, broken JSON is wrapped."""
    text = as_col(c)
    wrapped = F.to_json(F.struct(text.alias("raw")))
    return (
        F.when(text.isNull(), F.lit("{}"))
        .when(F.try_parse_json(text).isNotNull(), text)
        .otherwise(wrapped)
    )


def json_to_vector(c: Column | str) -> Column:
    """JSON array text as ``array<float>``."""
    return F.from_json(as_col(c), "array<float>")


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def slug(name: str) -> str:
    """Column-name form of a value: lower case, runs of blanks and dashes as ``_``, no other signs."""
    out = re.sub(r"[^a-z0-9_]", "", re.sub(r"[\s-]+", "_", name.lower()))
    return f"_{out}" if out[:1].isdigit() else out


def escape_like(text: str) -> str:
    """Make ``%`` and ``_`` literal for LIKE with the backslash as escape sign."""
    return text.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_")
