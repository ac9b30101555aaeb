"""Files: rasters, vector tables, logs, capabilities, settings, and writing."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Compressions that raster exports may use (fixed values).
CODECS = ("JPEG", "LZW", "PACKBITS", "DEFLATE", "CCITTRLE", "CCITTFAX3", "CCITTFAX4", "LZMA", "ZSTD", "LERC", "LERC_DEFLATE", "LERC_ZSTD", "WEBP", "JXL", "NONE")
#: Those that Parquet has under another name; others are refused, as Parquet has no image codecs.
PARQUET_CODECS = {"NONE": "none", "DEFLATE": "gzip", "ZSTD": "zstd"}


def raster_files(spark: SparkSession, folder: str, recursive: bool = False, glob: str = "*.{tif,tiff}", content: bool = True) -> DataFrame:
    """path, relative path, length and content of raster files; without content nothing of them is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(folder)
    root = folder.rstrip("/").split(":", 1)[-1].lstrip("/")
    rel = F.regexp_replace("path", f"^.*?{root.replace('.', chr(92) + '.')}/", "")
    return files.select("path", rel.alias("relative"), "length", *(["content"] if content else []))


def name_parts(name: Column, fields: list[str], sep: str = "_") -> Column:
    """A struct of a name's parts; a name with another number of parts is an error."""
    parts = F.split(name, sep)
    checked = F.when(F.size(parts) == len(fields), parts).otherwise(F.raise_error(F.concat(F.lit("unexpected name: "), name)).cast("array<string>"))
    return F.struct(*(F.get(checked, F.lit(k)).alias(f) for k, f in enumerate(fields)))


def tile_key(name: Column) -> Column:
    """minx, maxy (dm), row, col of a tile's file name."""
    p = name_parts(F.regexp_replace(name, r"\.tiff?$", ""), ["minx", "maxy", "row", "col"])
    return F.struct(*(p[f].cast("long").alias(f) for f in ("minx", "maxy")), *(p[f].cast("int").alias(f) for f in ("row", "col")))


def training_log(spark: SparkSession, path: str, mode: str = "train") -> DataFrame:
    """Lines of a JSON log; lines of another mode, or of none such as the first one's settings, are left out."""
    return spark.read.json(path).where(F.col("mode") == mode)


def settings(path: str, section: str) -> dict:
    """One script's section of a YAML file of settings; an unknown section is a KeyError."""
    import yaml

    return yaml.safe_load(Path(path).read_text())[section]


def split_table(spark: SparkSession, path: str) -> DataFrame:
    """split, id of a YAML file that lists ids by split."""
    import yaml

    rows = [(s, int(i)) for s, ids in yaml.safe_load(Path(path).read_text()).items() for i in ids or []]
    return spark.createDataFrame(rows, "split string, id long")


def write_split(df: DataFrame, path: str) -> None:
    """The ids of each split in order: a folder for each split, of YAML lists. Executors write; no id comes to the driver."""
    ranged = df.repartitionByRange("split", "id").sortWithinPartitions("split", "id")
    ranged.select("split", F.concat(F.lit("- "), F.col("id").cast("string")).alias("value")).write.mode("overwrite").partitionBy("split").text(path)


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """split, id of what write_split wrote."""
    rows = spark.read.option("basePath", path).text(path)
    return rows.select(F.col("split").cast("string").alias("split"), F.regexp_extract("value", r"^- (-?\d+)$", 1).cast("long").alias("id"))


def write_pairs(tiles: DataFrame, masks: DataFrame, splits: DataFrame, path: str) -> None:
    """Images with their masks (tile_id, data) by split, a folder for each: tiles without a mask or a split are left out."""
    pairs = tiles.select("tile_id", F.col("data").alias("image")).join(masks.select("tile_id", F.col("data").alias("mask")), "tile_id")
    pairs.join(splits.select(F.col("id").alias("tile_id"), "split"), "tile_id").write.mode("overwrite").partitionBy("split").parquet(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("split", "tile_id", "image", "mask")


def capabilities(spark: SparkSession, text: str) -> DataFrame:
    """path, tag, value, attributes of each element of a capabilities document, in order (place); names without their
    namespace. A document of a service, read on the driver."""
    rows: list[tuple] = []

    def walk(node: ET.Element, path: str, up: int | None) -> None:
        tag = node.tag.rpartition("}")[2]
        place = len(rows)
        rows.append((place, up, f"{path}/{tag}", tag, (node.text or "").strip() or None, {k.rpartition("}")[2]: v for k, v in node.attrib.items()}))
        for child in node:
            walk(child, f"{path}/{tag}", place)

    walk(ET.fromstring(text), "", None)
    return spark.createDataFrame(rows, "place int, parent int, path string, tag string, value string, attributes map<string,string>")


def layer(elements: DataFrame, identifier: str) -> DataFrame:
    """The children of the layer with an identifier: tag, value, attributes; nothing if there is none."""
    own = elements.where((F.col("tag") == "Identifier") & F.col("path").endswith("/Layer/Identifier") & (F.col("value") == identifier)).select(F.col("parent").alias("layer"))
    return elements.join(F.broadcast(own), elements["parent"] == own["layer"], "left_semi").select("tag", "value", "attributes")


def tile_matrices(elements: DataFrame, matrix_set: str) -> DataFrame:
    """identifier, scale, left, top, tile_width, tile_height, width, height of the matrices of a set, in order."""
    sets = elements.where((F.col("tag") == "Identifier") & F.col("path").endswith("/TileMatrixSet/Identifier") & (F.col("value") == matrix_set)).select(F.col("parent").alias("set_"))
    matrices = elements.where(F.col("tag") == "TileMatrix").join(sets, F.col("parent") == F.col("set_")).select(F.col("place").alias("matrix"))
    fields = elements.join(matrices, F.col("parent") == F.col("matrix")).groupBy("matrix").pivot("tag", ["Identifier", "ScaleDenominator", "TopLeftCorner", "TileWidth", "TileHeight", "MatrixWidth", "MatrixHeight"]).agg(F.first("value"))
    corner = F.split("TopLeftCorner", r"\s+")
    return fields.orderBy("matrix").select(F.col("Identifier").alias("identifier"), F.col("ScaleDenominator").cast("double").alias("scale"), corner[0].cast("double").alias("left"), corner[1].cast("double").alias("top"), *(F.col(c).cast("int").alias(n) for c, n in (("TileWidth", "tile_width"), ("TileHeight", "tile_height"), ("MatrixWidth", "width"), ("MatrixHeight", "height"))))


def write_tiles(tiles: DataFrame, path: str, by: tuple[str, ...] = ("product", "year"), codec: str = "zstd", overwrite: bool = False) -> None:
    """Tiles as Parquet by product and year; overwrite replaces only the parts that are written."""
    spark_codec = PARQUET_CODECS.get(codec.upper(), codec.lower())
    if codec.upper() in CODECS and codec.upper() not in PARQUET_CODECS:
        raise ValueError(f"Parquet has no {codec} compression")
    if spark_codec not in ("snappy", "gzip", "zstd", "lz4", "none"):
        raise ValueError(f"unknown compression: {codec}")
    out = tiles.write.option("compression", spark_codec).option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    out.mode("overwrite" if overwrite else "append").parquet(path)


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """A metric table (few rows by nature) as one CSV file with a header."""
    df.coalesce(1).write.option("header", True).mode("append" if append else "overwrite").csv(path)


def missing_only(wanted: DataFrame, there: DataFrame, keys: list[str], overwrite: bool = False) -> DataFrame:
    """What still has to be made: all if overwrite, else what isn't there."""
    return wanted if overwrite else wanted.join(there.select(keys).distinct(), keys, "left_anti")


def upsert_names(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with new's missing keys appended, and with new's further columns filled in where keys meet."""
    more = [c for c in new.columns if c not in old.columns]
    widened = old.join(new.select(key, *more), key, "left") if more else old
    return widened.unionByName(new.join(old.select(key), key, "left_anti"), allowMissingColumns=True)


def encode_tiles(px: DataFrame, value: str, edge: int, key: str = "tile_id", empty: int = 0) -> DataFrame:
    """Pixels as one row for each tile with its values as unsigned bytes in data; missing pixels are `empty`."""
    import numpy as np

    def run(table: pa.Table) -> pa.Table:
        out = np.full((edge, edge), empty, np.uint8)
        out[table["r"].to_numpy(), table["c"].to_numpy()] = table[value].to_numpy()
        return pa.table({key: pa.array([table[key][0].as_py()], pa.int64()), "height": pa.array([edge], pa.int32()), "width": pa.array([edge], pa.int32()), "data": pa.array([out.tobytes()], pa.binary())})

    return px.select(F.col(key).cast("long").alias(key), "r", "c", value).groupBy(key).applyInArrow(run, f"{key} long, height int, width int, data binary")


def map_tiles(tiles: DataFrame, kernel) -> DataFrame:
    """Each tile's data through kernel(array) -> array of unsigned bytes: the bulk form of expressions over pixels."""
    import numpy as np

    schema = tiles.schema

    def run(batches):
        for batch in batches:
            at = batch.schema.names.index("data")
            h, w = (batch.column(batch.schema.names.index(n)).to_pylist() for n in ("height", "width"))
            made = [np.asarray(kernel(np.frombuffer(x, np.uint8).reshape(a, b)), np.uint8) for x, a, b in zip(batch.column(at).to_pylist(), h, w, strict=True)]
            columns = {n: batch.column(k) for k, n in enumerate(batch.schema.names)} | {"data": pa.array([m.tobytes() for m in made], pa.binary()), "height": pa.array([m.shape[0] for m in made], pa.int32()), "width": pa.array([m.shape[1] for m in made], pa.int32())}
            yield pa.RecordBatch.from_pydict(columns)

    return tiles.mapInArrow(run, schema)


def reclassify_tiles(tiles: DataFrame, mapping: dict[int, int], strict: bool = True) -> DataFrame:
    """Tiles' classes by a table of 256 entries; a class without one is an error if strict, else 0."""
    import numpy as np

    lut = np.full(256, -1, np.int64)
    for k, v in mapping.items():
        lut[k] = v

    def kernel(a):
        out = lut[a]
        if strict and (out < 0).any():
            raise KeyError(f"no class for {int(a[out < 0][0])}")
        return np.maximum(out, 0)

    return map_tiles(tiles, kernel)


def decode_tiles(tiles: DataFrame, value: str, key: str = "tile_id") -> DataFrame:
    """The pixels of tiles: one row each, for small inputs."""
    bytes_ = F.expr("transform(sequence(0, height * width - 1), i -> CAST(conv(hex(substring(data, i + 1, 1)), 16, 10) AS INT))")
    px = tiles.select(key, "width", F.posexplode(bytes_).alias("i", value))
    return px.select(key, F.floor(F.col("i") / F.col("width")).cast("int").alias("r"), F.pmod("i", "width").cast("int").alias("c"), value)
