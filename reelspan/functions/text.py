"""Scalar functions over text, JSON and model responses."""

from __future__ import annotations

import mimetypes
import struct
import unicodedata
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

OCR_FIELDS = ("channel_name", "main_news_text", "thumbnail_text", "time")


@F.pandas_udf(StringType())
def fold_accents(s: pd.Series) -> pd.Series:
    """Canonical decomposition without combining marks; letters that do not decompose stay."""
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn"))


@F.pandas_udf(StringType())
def time_stamp(t: pd.Series) -> pd.Series:
    """MM:SS.mmm, rounding halves to even on the binary value; a carry to 60.000 is not propagated."""
    return t.map(lambda x: None if pd.isna(x) else f"{x // 60:02.0f}:{x % 60:06.3f}")


def strip(x: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(x, F.lit(" \t\n\r\x0b\x0c"))


def json_object(x: Column) -> Column:
    """What stands from the first { to the last }, or null if that is no JSON."""
    found = F.regexp_extract(x, r"(?s)\{.*\}", 0)
    return F.when((found != "") & F.try_parse_json(found).isNotNull(), found)


def strip_fences(x: Column) -> Column:
    return strip(F.regexp_replace(x, r"```(?:json)?", ""))


def ocr_text(raw: Column) -> Column:
    """First of extracted_texts if that is a string, "" if it is anything else; without that key the raw text, trimmed."""
    value = F.try_parse_json(json_object(raw))
    first = F.try_variant_get(value, "$.extracted_texts[0]", "variant")
    has = F.try_variant_get(value, "$.extracted_texts", "variant").isNotNull()
    text = F.when(F.schema_of_variant(first) == "STRING", strip(F.try_variant_get(value, "$.extracted_texts[0]", "string"))).otherwise(F.lit(""))
    return F.when(has, text).otherwise(strip(raw))


def structured_ocr(raw: Column) -> Column:
    """Struct of the four OCR fields, each "" when missing or when the response is no JSON object."""
    value = F.from_json(json_object(raw), ", ".join(f"{f} string" for f in OCR_FIELDS))
    return F.struct(*[F.coalesce(value[f], F.lit("")).alias(f) for f in OCR_FIELDS])


def split_tags(x: Column) -> Column:
    """Parts between space-pipe-space, untrimmed."""
    return F.split(x, " [|] ")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


#: The standard library's own table, whatever files of types a machine has.
_TYPES = mimetypes.MimeTypes()
#: Endings that say how a file is packed and are taken off before its type is told, and one that stands for two.
PACKED, DOUBLE = (".gz", ".Z", ".bz2", ".xz", ".br"), {".svgz": ".svg.gz", ".tgz": ".tar.gz", ".taz": ".tar.gz", ".tz": ".tar.gz", ".tbz2": ".tar.bz2", ".txz": ".tar.xz"}


def _ending(name: Column) -> Column:
    """The last dot of a name and what follows; empty for none, and for dots that begin the name."""
    return F.regexp_extract(name, r"[^.][.]*?(\.[^.]*)$", 1)


def media_type(path: Column, kinds: tuple[str, ...] = ("image", "audio", "video")) -> Column:
    """Media type by the name's ending, whatever its case, as the standard table has it; null for other kinds and unknown ones."""
    name = base_name(path)
    ending = _ending(name)
    for short, long in DOUBLE.items():
        name = F.when(F.lower(ending) == short, F.concat(F.left(name, F.char_length(name) - len(short)), F.lit(long))).otherwise(name)
    ending = _ending(name)
    name = F.when(ending.isin(*PACKED), F.left(name, F.char_length(name) - F.char_length(ending))).otherwise(name)
    known = {e: k for e, k in _TYPES.types_map[True].items() if k.split("/")[0] in kinds}
    return F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])[F.lower(_ending(name))]


def image_mime(path: Column) -> Column:
    """Media type of an image by its name; null for others."""
    return F.coalesce(media_type(path, ("image",)), F.when(F.lower(_ending(base_name(path))) == ".webp", "image/webp"))


def base64_of(content: Column) -> Column:
    """Base64 in one line."""
    return F.translate(F.base64(content), "\r\n", "")


def data_uri(mime: Column, content: Column) -> Column:
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), base64_of(content))


def is_image_uri(x: Column) -> Column:
    """Begins with data:image/ and holds the base64 marker, with padded base64 up to the next marker or the end."""
    data = F.get(F.split(x, "base64,"), F.lit(1))
    return F.coalesce(x.startswith("data:image/") & (F.char_length(data) % 4 == 0) & F.rlike(data, F.lit("^[A-Za-z0-9+/]*={0,2}\\z")), F.lit(False))


@F.pandas_udf(BinaryType())
def png(width: pd.Series, height: pd.Series, pixels: pd.Series) -> pd.Series:
    """A lossless PNG of 8-bit RGB pixels in row order; null where their number does not fit the size."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    def encode(w, h, rgb):
        if rgb is None or pd.isna(w) or pd.isna(h) or len(rgb) != 3 * w * h:
            return None
        rows = b"".join(b"\0" + bytes(rgb[3 * w * i : 3 * w * (i + 1)]) for i in range(h))
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")

    return pd.Series([encode(*x) for x in zip(width, height, pixels)])


def is_url(x: Column) -> Column:
    return x.startswith("http://") | x.startswith("https://")


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def mask_token(x: Column) -> Column:
    return F.concat(F.left(x, F.lit(4)), F.lit("..."), F.right(x, F.lit(4)))


def uptime(seconds: Column) -> Column:
    """Days, if any, then hours, minutes and seconds."""
    days = F.floor(seconds / 86400)
    clock = F.format_string("%d:%02d:%02d", F.floor(seconds % 86400 / 3600), F.floor(seconds % 3600 / 60), F.floor(seconds % 60))
    return F.concat(F.when(days == 1, "1 day, ").when(days > 1, F.concat(days.cast("string"), F.lit(" days, "))).otherwise(""), clock)


def batch_count(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("long")


#: Names that go to the first provider without its prefix; prefixes of the two providers' models.
OTHER_NAMES = ("gpt-4o", "gpt-4-vision-preview")
PREFIXES = {"gemini": ("gemini-",), "mistral": ("mistral-", "pixtral-", "codestral-")}

#: Parts of lower-cased errors that retire a key of each provider, and that remove one of the first provider's.
RETIRE = {
    "gemini": ("quota", "rate limit", "exceeded", "invalid argument", "internal error", "504", "503", "500", "429"),
    "mistral": ("quota", "rate limit", "exceeded", "permission_denied", "unauthorized", "invalid api key"),
}
REMOVE = ("api key not valid", "suspended", "api key expired", "permission_denied", "expired")

#: What an error's text holds, and what the user is told.
TOLD = (
    ("Connection refused", "Connection Failed. Is the AI Gateway server running at %s?"),
    ("All Gemini API keys have been exhausted", "Server reported that all Gemini keys are exhausted or have failed. Please check the server logs."),
    ("Mistral request failed after", "Server reported that all retries for Mistral failed. The Mistral API might be down or all keys are invalid."),
)


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def model_route(model: Column) -> Column:
    """Provider of a model name, whatever its case; `unsupported` for names of neither."""
    name = F.lower(model)
    first, second = (_any(name.startswith(x) for x in PREFIXES[k]) for k in ("gemini", "mistral"))
    return F.when(first | name.isin(*OTHER_NAMES), "gemini").when(second, "mistral").otherwise("unsupported")


def error_class(message: Column, provider: Column) -> Column:
    """retire, remove or other: what a provider's error means for the key, by parts of the lower-cased message.

    The first provider tries the retiring parts before the removing ones and retires the key on any other error, too;
    the second one leaves the key alone then.
    """
    low = F.lower(message)
    first = F.when(_any(low.contains(x) for x in RETIRE["gemini"]), "retire").when(_any(low.contains(x) for x in REMOVE), "remove").otherwise("retire")
    second = F.when(_any(low.contains(x) for x in RETIRE["mistral"]), "retire").otherwise("other")
    return F.when(provider == "mistral", second).otherwise(first)


def user_message(message: Column, base_url: str = "") -> Column:
    """What a user is told of an error."""
    (refused, where), *rest = TOLD
    out = F.when(message.contains(refused), where % base_url)
    for part, said in rest:
        out = out.when(message.contains(part), said)
    return out.otherwise(F.concat(F.lit("An unhandled error occurred: "), message))


def text_of_parts(parts: Column) -> Column:
    """Text parts of a message joined by a space."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: p["text"]), " ")


def has_image(parts: Column) -> Column:
    return F.exists(parts, lambda p: (p["type"] == "image_url") & is_image_uri(p["image_url"]))


def vision_model(model: Column, parts: Column, vision: list[str], default: str) -> Column:
    """The model, or the default vision model when the content is a list of parts and the model sees no images."""
    return F.when(parts.isNotNull() & ~F.lower(model).isin(*vision), F.lit(default)).otherwise(model)


def normalise_pixel(value: Column, mean: float, std: float) -> Column:
    """An 8-bit channel scaled to 0..1, less the channel's mean, over its deviation."""
    return (value / F.lit(255.0) - F.lit(mean)) / F.lit(std)
