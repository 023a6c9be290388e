"""Image folders and archives as item tables; pixel features with numpy alone."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Classes that a path segment can name, and image file endings.
CLASSES = ("ADI", "BACK", "DEB", "LYM", "MUC", "MUS", "NORM", "STR", "TUM")
ENDINGS = "*.{tif,tiff,png,jpg,jpeg,TIF,TIFF,PNG,JPG,JPEG}"


def class_in_path(path: Column) -> Column:
    """The first segment that is a class, else UNK."""
    return F.coalesce(F.try_element_at(F.filter(F.split(path, "/"), lambda p: p.isin(*CLASSES)), F.lit(1)), F.lit("UNK"))


def split_of(key: Column) -> Column:
    """val for keys that contain VAL or end in _7K, else train."""
    name = F.upper(key)
    return F.when(name.contains("VAL") | name.endswith("_7K"), "val").otherwise("train")


def text_of(version: str, source: Column, split: Column, label: Column, width: Column, height: Column, mpp: float) -> Column:
    if version == "disabled":
        return F.lit("")
    if version in ("v1", "v1_with_label", "with_label"):
        return F.format_string("Histopathology patch. Dataset=%s. Split=%s. Label=%s.", source, split, label)
    if version in ("v2", "v2_no_label", "no_label"):
        return F.format_string("Histopathology patch. Dataset=%s. Split=%s. TileSize=%dx%d. MPP=%.3f.", source, split, width, height, F.lit(float(mpp)))
    raise ValueError(f"unknown text template {version!r}")


def image_size(data: bytes | None) -> tuple[int, int]:
    """Width and height from a PNG, JPEG or TIFF header; -1 for others."""
    if not data:
        return -1, -1
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:2] == b"\xff\xd8":
            at = 2
            while at + 9 < len(data):
                mark, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
                if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                    return w, h
                at += 2 + size
        if data[:4] in (b"II*\0", b"MM\0*"):
            e = "<" if data[:2] == b"II" else ">"
            at = struct.unpack(e + "I", data[4:8])[0]
            found = {}
            for k in range(struct.unpack(e + "H", data[at : at + 2])[0]):
                entry = data[at + 2 + 12 * k : at + 14 + 12 * k]
                tag, kind = struct.unpack(e + "HH", entry[:4])
                found[tag] = struct.unpack(e + ("H" if kind == 3 else "I"), entry[8 : 10 if kind == 3 else 12])[0]
            return found[256], found[257]
    except (struct.error, KeyError):
        pass
    return -1, -1


def items_from_folder(spark: SparkSession, folder: str, source: str, split: str, mpp: float = 0.5, text_template: str = "v2_no_label") -> DataFrame:
    """The canonical items of <folder>/<label>/<file>: headers are read, pixels are not decoded."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", ENDINGS).option("recursiveFileLookup", "true").load(folder)

    @F.pandas_udf("width int, height int")
    def size(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([image_size(d) for d in data], columns=["width", "height"]).astype("int32")

    parts = F.split("path", "/")
    rows = files.select(F.col("path").alias("image_path"), F.element_at(parts, -2).alias("label"), F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "").alias("stem"), size("content").alias("size"))
    rows = rows.select("image_path", "label", "stem", "size.*", F.lit(source).alias("source"), F.lit(split).alias("split"), F.lit(float(mpp)).alias("mpp"))
    text = text_of(text_template, F.col("source"), F.col("split"), F.col("label"), F.col("width"), F.col("height"), mpp)
    return rows.select(F.concat_ws("::", "source", "split", "label", "stem").alias("item_id"), "source", "split", "label", text.alias("text"), "image_path", "width", "height", "mpp")


def otsu(gray: np.ndarray) -> int:
    """The threshold of greatest variance between the two sides, of an 8-bit image."""
    n = np.bincount(gray.ravel(), minlength=256).astype(float)
    w = np.cumsum(n)
    m = np.cumsum(n * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (m[-1] * w / w[-1] - m) ** 2 / (w * (w[-1] - w))
    return int(np.nan_to_num(between).argmax())


def pixel_features(rgb: np.ndarray) -> dict[str, float]:
    """Means and deviations of colours and gray, tissue share (gray at most Otsu's threshold), variance of the Laplacian, saturation."""
    x = rgb.astype(float)
    gray = x @ np.array([0.299, 0.587, 0.114])
    g8 = np.clip(np.round(gray), 0, 255).astype(np.uint8)
    lap = np.zeros_like(gray)
    p = np.pad(gray, 1, mode="reflect")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * gray
    top = x.max(2)
    sat = np.where(top > 0, (top - x.min(2)) / np.maximum(top, 1e-12), 0) * 255
    out = {f"{s}_{c}": float(f(x[..., i])) for i, c in enumerate("rgb") for s, f in (("mean", np.mean), ("std", np.std))}
    return out | {"mean_gray": float(gray.mean()), "std_gray": float(gray.std()), "tissue_coverage": float((g8 <= otsu(g8)).mean()), "blur_var_lap": float(lap.var()), "sat_mean": float(sat.mean()), "sat_std": float(sat.std())}


def histogram_vector(rgb: np.ndarray, bins: int = 16) -> np.ndarray:
    """bins counts of each channel as shares, means and deviations, of length 1 in all."""
    x = rgb.reshape(-1, 3)
    parts = [np.histogram(x[:, c], bins=bins, range=(0, 256))[0] / max(1, len(x)) for c in range(3)]
    v = np.concatenate([*parts, x.mean(0) / 255, x.std(0) / 255])
    return v / max(1e-12, float(np.linalg.norm(v)))


#: A PNG's first bytes, and samples a pixel of its colour types.
PNG_HEAD, PNG_SAMPLES = b"\x89PNG\r\n\x1a\n", {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def decode_png(data: bytes) -> np.ndarray:
    """height x width x 3 bytes of a PNG of 8 or 16 bits a sample or a palette, not interlaced; transparency is left out. ValueError for anything else."""
    if data[:8] != PNG_HEAD:
        raise ValueError("not a PNG")
    at, chunks, palette = 8, [], None
    width = height = depth = colour = 0
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        at += size + 12
        if kind == b"IHDR":
            width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", body)
            if interlaced or colour not in PNG_SAMPLES or depth not in (8, 16) and colour != 3 or depth > 8 and colour == 3:
                raise ValueError("a kind of PNG that is not read here")
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            chunks.append(body)
    samples = PNG_SAMPLES[colour]
    step = max(1, samples * depth // 8)
    stride = -(-width * samples * depth // 8)
    lines = np.frombuffer(zlib.decompress(b"".join(chunks)), np.uint8).reshape(height, stride + 1)
    out = np.zeros((height + 1, stride), np.uint8)
    for y in range(height):
        out[y + 1] = unfiltered(int(lines[y, 0]), lines[y, 1:], out[y], step)
    pixels = out[1:]
    if depth == 16:
        pixels = pixels[:, ::2]
    elif depth < 8:
        bits = np.unpackbits(pixels, axis=1).reshape(height, -1, depth)[:, :width]
        pixels = bits @ (1 << np.arange(depth - 1, -1, -1))
    pixels = pixels.reshape(height, width, samples)
    if colour == 3:
        return palette[pixels[..., 0]]
    return np.repeat(pixels[..., :1], 3, axis=2) if samples < 3 else pixels[..., :3]


def unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A line of a PNG without its filter: each byte was written as a difference to its neighbours."""
    if kind == 0:
        return line
    if kind == 2:
        return line + above
    if kind == 1:  # to the pixel on the left: running sums of each sample
        padded = np.zeros(-(-len(line) // step) * step, np.uint8)
        padded[: len(line)] = line
        return np.cumsum(padded.reshape(-1, step), axis=0, dtype=np.uint8).ravel()[: len(line)]
    raw, up = line.tolist(), above.tolist()
    made = [0] * step + raw
    up = [0] * step + up
    for i in range(step, len(made)):
        left, top, corner = made[i - step], up[i], up[i - step]
        if kind == 3:
            guess = (left + top) // 2
        elif kind == 4:
            by = (abs(top - corner), abs(left - corner), abs(left + top - 2 * corner))
            guess = (left, top, corner)[by.index(min(by))]
        else:
            raise ValueError("unknown filter")
        made[i] = (made[i] + guess) & 255
    return np.array(made[step:], np.uint8)


def histogram_embeddings(images: DataFrame, decode: Callable[[bytes], np.ndarray] = decode_png, bins: int = 16, model_id: str = "rgb_histogram") -> DataFrame:
    """item_id, modality `image`, model_id, dim, vector: histogram_vector() of images (item_id, content). Images that cannot be decoded have a vector of zeros."""
    dim = 3 * bins + 6

    def run(frames):
        for f in frames:
            vectors = []
            for data in f["content"]:
                try:
                    vectors.append(histogram_vector(decode(bytes(data)), bins).astype(np.float32))
                except Exception:  # a broken image has no colours
                    vectors.append(np.zeros(dim, np.float32))
            yield pd.DataFrame({"item_id": f["item_id"], "vector": vectors})

    kind = images.schema["item_id"].dataType.simpleString()
    made = images.select("item_id", "content").mapInPandas(run, f"item_id {kind}, vector array<float>")
    return made.select("item_id", F.lit("image").alias("modality"), F.lit(model_id).alias("model_id"), F.lit(dim).cast("long").alias("dim"), "vector")


def contents(spark: SparkSession, items: DataFrame) -> DataFrame:
    """item_id, content: the files of items (item_id, image_path), read in the tasks."""
    folders = items.select(F.regexp_replace("image_path", r"[^/]*$", "").alias("f")).distinct()
    paths = [r[0] for r in folders.collect()]  # a row for each folder
    files = spark.read.format("binaryFile").option("pathGlobFilter", ENDINGS).load(paths)
    return files.select(F.col("path").alias("image_path"), "content").join(items.select("item_id", "image_path"), "image_path").select("item_id", "content")


def features_of(images: DataFrame, decode: Callable[[bytes], np.ndarray] = decode_png) -> DataFrame:
    """item_id, morph_error and pixel_features() of images (item_id, content); decode: bytes -> height x width x 3. Images that it fails on have error 1 and nulls."""
    names = list(pixel_features(np.zeros((4, 4, 3), np.uint8)))

    def run(frames):
        for f in frames:
            rows = []
            for i, data in zip(f["item_id"], f["content"], strict=True):
                try:
                    rows.append({"item_id": i, "morph_error": 0, **pixel_features(decode(data))})
                except Exception:  # a broken image is a row with the error set
                    rows.append({"item_id": i, "morph_error": 1})
            yield pd.DataFrame(rows, columns=["item_id", "morph_error", *names])

    return images.select("item_id", "content").mapInPandas(run, "item_id string, morph_error int, " + ", ".join(f"{n} double" for n in names))
