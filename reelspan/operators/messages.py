"""Chat requests: validation, history split, part conversion, responses; image tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspan.functions.text import base_name, data_uri, has_image, image_mime, media_type, text_of_parts


def truth(v: Column) -> Column:
    """Whether a JSON value counts: not null, false, zero or empty."""
    kind = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | (kind == "VOID"), False)
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "STRING", F.try_variant_get(v, "$", "string") != "")
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(True)))
    )


def chat_request_status(body: Column) -> Column:
    """HTTP status of a chat request: 400 for bad JSON or a `stream` that counts, 500 for JSON that is no object, else 200."""
    v = F.try_parse_json(body)
    streams = truth(F.try_variant_get(v, "$.stream", "variant"))
    return F.when(v.isNull(), 400).when(~F.schema_of_variant(v).startswith("OBJECT"), 500).when(streams, 400).otherwise(200)


def upload_media_type(explicit: Column, file_name: Column) -> Column:
    """The stated media type, else one by the name's ending; null unless audio or video."""
    kind = F.coalesce(F.nullif(explicit, F.lit("")), media_type(file_name, ("audio", "video")))
    return F.when(kind.startswith("audio/") | kind.startswith("video/"), kind)


def file_upload_status(parts: Column) -> Column:
    """400 unless the first part is named file and the second purpose."""
    return F.when((F.get(parts, F.lit(0)) == "file") & (F.get(parts, F.lit(1)) == "purpose"), 200).otherwise(400)


def split_history(messages: DataFrame, key: str = "conv_id", at: str = "turn") -> DataFrame:
    """messages with provider_role (assistant: model, others: user) and is_last; history without string content goes."""
    w = Window.partitionBy(key).orderBy(F.desc(at))
    out = messages.withColumn("is_last", F.row_number().over(w) == 1).withColumn("provider_role", F.when(F.col("role") == "assistant", "model").otherwise("user"))
    return out.filter(F.col("is_last") | F.col("content_text").isNotNull())


def content_of(messages: DataFrame) -> DataFrame:
    """messages with text (of the string or the text parts) and sends_images (a decodable image among the parts)."""
    return messages.withColumn("text", F.coalesce("content_text", text_of_parts(F.col("parts")), F.lit(""))).withColumn("sends_images", F.coalesce(has_image(F.col("parts")), F.lit(False)))


#: Why a request is refused, and what an image that cannot be read puts before the text.
NEEDS, ONLY_USER, ONLY_TEXT = "Either 'prompt' or 'messages' must be provided.", "Images can only be added to the most recent 'user' message in the history.", "The last message content must be a string when providing new images."
FAILED, MISSING, UNKNOWN_TYPE = "[Error processing image %d: Error processing image file %s: %s]\n", "Image file not found at %s", "Unsupported or unknown image format for file: %s"


def with_pictures(requests: DataFrame, files: DataFrame, key: str, images: str = "images") -> DataFrame:
    """requests with `pictures`, for each path of `images` in order: (path, uri, error), a data URI of the file's content or why there is none.

    files(path, content), one row a path.  Paths are joined before contents come in, so a file travels once for each
    request that shows it; the join splits a path that many requests share where it is large.
    """
    asked = requests.select(key, F.posexplode(images).alias("n", "path"))
    read = asked.join(files.select("path", "content"), "path", "left")
    kind = image_mime(F.col("path"))
    error = F.when(F.col("content").isNull(), F.format_string(MISSING, "path")).when(kind.isNull(), F.format_string(UNKNOWN_TYPE, base_name(F.col("path"))))
    made = F.struct("n", "path", F.when(error.isNull(), data_uri(kind, F.col("content"))).alias("uri"), error.alias("error"))
    pictures = read.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(made)), lambda x: x.dropFields("n")).alias("pictures"))
    out = requests.join(pictures, key, "left")
    return out.withColumn("pictures", F.coalesce("pictures", F.array().cast(out.schema["pictures"].dataType)))


def assemble(prompt: Column, messages_n: Column, last_role: Column, last_text: Column, pictures: Column) -> Column:
    """Struct (error, parts) of a request of a prompt, or of messages, beside which a prompt does not count; an empty prompt is none.

    Images go only on a last user message of string content; one that could not be read puts a line before the text, the
    latest first.  A last message of list content has no parts here: it stays as it is.
    """
    none = F.coalesce(messages_n, F.lit(0)) == 0
    role, text = F.when(none, "user").otherwise(last_role), F.when(none, F.coalesce(prompt, F.lit(""))).otherwise(last_text)
    numbered = F.transform(pictures, lambda p, i: F.struct((i + 1).alias("n"), p["path"].alias("path"), p["uri"].alias("uri"), p["error"].alias("error")))
    lines = F.transform(F.reverse(F.filter(numbered, lambda x: x["uri"].isNull())), lambda x: F.format_string(FAILED, x["n"], x["path"], x["error"]))
    said = F.array(F.struct(F.lit("text").alias("type"), F.concat(F.array_join(lines, ""), text).alias("value")))
    shown = F.transform(F.filter(pictures, lambda p: p["uri"].isNotNull()), lambda p: F.struct(F.lit("image_url").alias("type"), p["uri"].alias("value")))
    some = F.size(pictures) > 0
    error = F.when(none & F.coalesce(prompt == "", F.lit(True)), NEEDS).when(some & F.coalesce(role != "user", F.lit(True)), ONLY_USER).when(some & text.isNull(), ONLY_TEXT)
    return F.struct(error.alias("error"), F.when(error.isNull() & text.isNotNull(), F.concat(said, shown)).alias("parts"))


def completion(model: Column, text: Column, created: Column, request_id: Column) -> Column:
    """The JSON of an OpenAI-style chat completion; tokens are not counted."""
    choice = F.struct(F.lit(0).alias("index"), F.struct(F.lit("assistant").alias("role"), text.alias("content")).alias("message"), F.lit("stop").alias("finish_reason"))
    usage = F.struct(*[F.lit(0).alias(x) for x in ("prompt_tokens", "completion_tokens", "total_tokens")])
    return F.to_json(F.struct(request_id.alias("id"), F.lit("chat.completion").alias("object"), created.alias("created"), model.alias("model"), F.array(choice).alias("choices"), usage.alias("usage")))


def tile_grid(images: DataFrame, size: int = 448, most: int = 12, least: int = 1) -> DataFrame:
    """images(width, height) with cols, rows: the grid whose aspect is nearest; among equals the last by (area, cols, rows) whose half area the image exceeds."""
    grids = [(c * r, c, r) for c in range(1, most + 1) for r in range(1, most + 1) if least <= c * r <= most]
    order = F.array(*[F.struct(F.lit(a).alias("area"), F.lit(c).alias("cols"), F.lit(r).alias("rows")) for a, c, r in sorted(grids)])
    apart = lambda g: F.abs(F.col("width") / F.col("height") - g["cols"] / g["rows"])
    zero = F.struct(F.lit(float("inf")).alias("d"), F.lit(1).alias("cols"), F.lit(1).alias("rows"))

    def step(acc, g):
        d = apart(g)
        wins = (d < acc["d"]) | ((d == acc["d"]) & (F.col("width") * F.col("height") > 0.5 * size * size * g["area"]))
        return F.struct(F.when(wins, d).otherwise(acc["d"]).alias("d"), F.when(wins, g["cols"]).otherwise(acc["cols"]).alias("cols"), F.when(wins, g["rows"]).otherwise(acc["rows"]).alias("rows"))

    best = F.aggregate(order, zero, step)
    return images.withColumn("_g", best).withColumn("cols", F.col("_g.cols")).withColumn("rows", F.col("_g.rows")).drop("_g")


def tile_boxes(images: DataFrame, size: int = 448) -> DataFrame:
    """One row a tile of images(cols, rows): its box in the resized image; a thumbnail (tile -1) when there are several."""
    tiles = images.withColumn("tile", F.explode(F.concat(F.sequence(F.lit(0), F.col("cols") * F.col("rows") - 1), F.when(F.col("cols") * F.col("rows") > 1, F.array(F.lit(-1))).otherwise(F.array().cast("array<int>")))))
    x, y = F.col("tile") % F.col("cols") * size, F.floor(F.col("tile") / F.col("cols")).cast("int") * size
    return tiles.withColumn("x0", F.when(F.col("tile") >= 0, x).otherwise(0)).withColumn("y0", F.when(F.col("tile") >= 0, y).otherwise(0)).withColumn("x1", F.col("x0") + size).withColumn("y1", F.col("y0") + size)
