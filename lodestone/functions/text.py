"""Text functions: language keys, versions, paths and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Subtags that mark traditional Chinese.
TRADITIONAL = ["hant", "tw", "hk", "mo"]


def normalize_language(code: Column) -> Column:
    """The registry key of a language tag: its base in lower case, with zh and zh_hant told apart."""
    parts = F.split(F.lower(code), "[-_]")
    traditional = F.exists(F.slice(parts, 2, F.size(parts)), lambda p: p.isin(TRADITIONAL))
    return F.when((parts[0] == "zh") & traditional, F.lit("zh_hant")).otherwise(parts[0])


def pair_key(source: Column, target: Column) -> Column:
    return F.concat_ws("-", normalize_language(source), normalize_language(target))


def version(text: Column) -> Column:
    """A leading vX.Y.Z, else the text as it is."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"^(v\d+\.\d+\.\d+)", 1), F.lit("")), text)


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends (trim() takes spaces only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def title(text: Column) -> Column:
    """Every run of letters with one upper-case letter ahead; initcap() goes by spaces only."""
    parts = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))), "")


def url_join(base: Column, path: Column) -> Column:
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(path, F.lit("/")))


def url_parent(url: Column) -> Column:
    return F.regexp_replace(url, "/[^/]*$", "")


def name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)/?$", 1)


def stem(path: Column) -> Column:
    """The name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(name(path), r"(?<=.)\.[^.]+$", "")


def suffix(path: Column) -> Column:
    return F.regexp_extract(name(path), r".(\.[^.]+)$", 1)


def with_suffix(path: Column, new: str) -> Column:
    """Only the last suffix is swapped: x.tar.gz with .sha256 is x.tar.sha256."""
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", ""), F.lit(new))


def shard_name(split: Column, shard: Column, shards: Column) -> Column:
    return F.format_string("%s-%05d-of-%05d.parquet", split, shard.cast("int"), shards.cast("int"))


def voice_name(path: Column) -> Column:
    """language/locale/voice[/quality] as locale-voice-quality; medium where the quality is missing."""
    parts = F.split(path, "/")
    known = F.concat_ws("-", parts[1], parts[2], F.coalesce(F.get(parts, F.lit(3)), F.lit("medium")))
    return F.when(F.size(parts) >= 3, known).otherwise(F.raise_error(F.concat(F.lit("not a voice path: "), path)))


def bundle_id(prefix: str, variant: Column) -> Column:
    """Without the quantization suffix, so that variants of one model share an id."""
    return F.concat(F.lit(f"{prefix}."), F.substring_index(variant, "-", 1))


def to_boolean(text: Column) -> Column:
    low = F.lower(text)
    error = F.raise_error(F.concat(F.lit("not a boolean: "), F.coalesce(text, F.lit("null"))))
    return F.when(low.isin("yes", "true", "t", "y", "1"), F.lit(True)).when(low.isin("no", "false", "f", "n", "0"), F.lit(False)).otherwise(error.cast("boolean"))


def in_blocks(token: Column, blocks: list[tuple[int, int]]) -> Column:
    """Every character lies in one of the code-point ranges."""
    return token.rlike("^[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in blocks) + "]+$")


def has_mark(text: Column) -> Column:
    return text.rlike(r"\p{M}")


def without_marks(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{M}", "")


def names_or_none(names: Column) -> Column:
    return F.coalesce(F.nullif(F.array_join(names, ", "), F.lit("")), F.lit("none"))


def guarded_dir(path: Column, protected: list[str]) -> Column:
    """path, or an error where it holds one of the protected parts."""
    bad = F.exists(F.array(*[F.lit(x) for x in protected]), lambda x: F.contains(path, x))
    return F.when(bad, F.raise_error(F.concat(F.lit("refused output folder: "), path))).otherwise(path)


def under(base: Column, value: Column, kind: T.DataType) -> Column:
    """value with base ahead of every text in it that names a file (has a suffix), at any depth of maps and structs;
    all else stays, absolute paths too. kind is the type of value."""
    if isinstance(kind, T.StringType):
        named = value.rlike(r"[^/.][^/]*\.[^/.]+/?$") & ~F.startswith(value, F.lit("/"))
        return F.when(F.coalesce(named, F.lit(False)), url_join(base, value)).otherwise(value)
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: under(base, v, kind.valueType))
    if isinstance(kind, T.StructType):
        inner = F.struct(*[under(base, value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), inner)
    return value


def punctuated(text: Column, r: Column, cjk: Column) -> Column:
    """Light punctuation by a uniform r; CJK has signs of its own."""
    c = F.when(r < 0.15, F.concat(text, F.lit("。"))).when(r < 0.22, F.concat(F.lit("「"), text, F.lit("」"))).when(r < 0.30, F.concat(text, F.lit("、")))
    other = F.when(r < 0.30, F.concat(text, F.lit("."))).when(r < 0.45, F.concat(text, F.lit(","))).when(r < 0.55, F.concat(F.lit('"'), text, F.lit('"'))).when(r < 0.60, F.regexp_replace(text, "^([^ ]*) ", "$1-"))
    return F.coalesce(F.when(cjk, c).otherwise(other), text)


def cased(text: Column, r: Column) -> Column:
    return F.when(r < 0.55, text).when(r < 0.80, title(text)).otherwise(F.upper(text))


def default(value: Column, other: Column, empty_too: bool = False) -> Column:
    """value or, where it is null (with empty_too also where it is empty), other."""
    return F.coalesce(F.nullif(value, F.lit("")) if empty_too else value, other)
