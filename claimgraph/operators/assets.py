"""Proof of binary models as Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import first_match

#: Fixed header values of binary glTF.
MAGIC, VERSION, JSON_CHUNK = "676C5446", 2, "4A534F4E"
LARGEST, LARGEST_JSON = 64 << 20, 16 << 20


def little_endian(c: Column, at: int) -> Column:
    """The unsigned 32-bit number at a byte place (from 0), null beyond the end."""
    h = F.hex(F.substring(c, at + 1, 4))
    turned = F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))
    return F.when(F.length(h) == 8, F.conv(turned, 16, 10).cast("long"))


def validate_assets(df: DataFrame, key: str, c: str, largest: int = LARGEST, observed: Column | None = None) -> DataFrame:
    """Header, JSON chunk, model spec, digests and status of binary model files; a row each, also for files over a limit."""
    content = F.col(c)
    out = df.select(
        key,
        F.octet_length(content).cast("long").alias("length"),
        F.hex(F.substring(content, 1, 4)).alias("magic"),
        little_endian(content, 4).alias("version"),
        little_endian(content, 8).alias("total"),
        little_endian(content, 12).alias("json_length"),
        F.hex(F.substring(content, 17, 4)).alias("chunk"),
        F.sha2(content, 256).alias("content_sha256"),
        content.alias("_c"),
        (F.octet_length(content).cast("long") if observed is None else observed).alias("observed"),
    )
    sound = (F.col("magic") == MAGIC) & (F.col("version") == VERSION) & (F.col("chunk") == JSON_CHUNK) & F.col("total").between(20, largest) & (F.col("json_length") > 0) & (F.col("json_length") <= LARGEST_JSON) & (20 + F.col("json_length") <= F.col("total"))
    piece = F.expr("substring(_c, 21, cast(json_length as int))")
    out = out.withColumn("sound", F.coalesce(sound, F.lit(False)))
    out = out.withColumn("json", F.when(F.col("sound"), F.expr("try_to_binary(hex(substring(_c, 21, cast(json_length as int))), 'hex')")).cast("string")).withColumn("json_sha256", F.when(F.col("sound"), F.sha2(piece, 256))).drop("_c")
    parsed = F.try_parse_json("json")
    has = lambda name: F.coalesce(F.expr("schema_of_variant(try_parse_json(json))").contains(f"{name}:"), F.lit(False))
    spec = first_match([(has("VRMC_vrm"), "1.0"), (has("VRM"), "0.x")])
    status = first_match(
        [
            (F.col("observed") > largest, "too_large"),
            (F.col("length").isNull(), "no_content"),
            ((F.col("magic") != MAGIC) | F.col("version").isNull(), "not_glb"),
            (F.col("total") > largest, "too_large"),
            (F.col("json_length") > LARGEST_JSON, "json_too_large"),
            (~F.col("sound"), "bad_header"),
            (parsed.isNull(), "bad_json"),
            (F.col("observed") != F.col("total"), "length_mismatch"),
            (F.col("spec").isNull(), "valid_glb_not_vrm"),
        ],
        "valid",
    )
    return out.withColumn("spec", F.when(F.col("sound"), spec)).withColumn("status", status)


def rig_proof(df: DataFrame, key: str, c: str) -> DataFrame:
    """Whether a glTF document has a mesh and a skin whose joints all name nodes."""
    doc = F.from_json(c, "struct<nodes:array<struct<name:string>>,meshes:array<struct<name:string>>,skins:array<struct<joints:array<int>>>>")
    out = df.select(key, doc.alias("d"))
    nodes = F.coalesce(F.size("d.nodes"), F.lit(0))
    good = F.exists("d.skins", lambda s: (F.size(s["joints"]) > 0) & F.forall(s["joints"], lambda j: (j >= 0) & (j < nodes)))
    return out.select(key, F.coalesce(F.size("d.meshes") > 0, F.lit(False)).alias("has_mesh"), F.coalesce(good, F.lit(False)).alias("has_rig")).withColumn("rigged", F.col("has_mesh") & F.col("has_rig"))


#: Fixed marks of FBX files: how a binary and a text file begin, what names its header, and what skeleton nodes are named.
FBX_BINARY = "4B617964617261204642582042696E6172792020001A00"
FBX_TEXT = "; FBX"
FBX_HEADER = "FBXHeaderExtension"
FBX_WIDE = 7500
FBX_SKELETON = ("LimbNode", "Deformer")


def fbx_proof(df: DataFrame, key: str, c: str, rigged: Column, evidence: Column, window: int = 4096) -> DataFrame:
    """FBX files by their first bytes: (key, form, version, skeleton, status, valid_avatar).

    ``form`` is binary or text, null if the bytes are no FBX. A binary file's version is the number behind its mark; its
    first node says where it ends, 32 bits wide before version 7500 and 64 from it on, and a file that is shorter, or ends
    before that number, is truncated. ``skeleton`` tells whether names of skeleton nodes occur, a lead and no proof: only
    a stated rig with evidence makes a valid avatar. Only byte windows and searches, all native; null content has a status.
    """
    content = F.col(c)
    long = lambda h: F.conv(F.concat(*(F.substring(h, 15 - 2 * i, 2) for i in range(8))), 16, 10).try_cast("long")
    head = F.hex(F.substring(content, 1, 23))
    latin = F.decode(content, "ISO-8859-1")
    first = F.decode(F.substring(content, 1, window), "ISO-8859-1")
    out = df.select(
        key,
        F.octet_length(content).cast("long").alias("length"),
        F.when(head == FBX_BINARY, "binary").when(F.ltrim(F.regexp_replace(first, r"^\s+", "")).startswith(FBX_TEXT) | first.contains(FBX_HEADER), "text").alias("form"),
        little_endian(content, 23).alias("version"),
        little_endian(content, 27).alias("_narrow"),
        F.when(F.octet_length(content) >= 35, long(F.hex(F.substring(content, 28, 8)))).alias("_wide"),
        F.coalesce(latin.contains(FBX_SKELETON[0]) & latin.contains(FBX_SKELETON[1]), F.lit(False)).alias("skeleton"),
        (F.coalesce(rigged, F.lit(False)) & F.coalesce(F.size(evidence) > 0, F.lit(False))).alias("_rigged"),
    )
    version = F.when(F.col("form") == "binary", F.col("version"))
    end = F.when(version >= FBX_WIDE, F.col("_wide")).otherwise(F.col("_narrow"))
    status = first_match(
        [
            (F.col("length").isNull(), "no_content"),
            (F.col("form").isNull(), "not_fbx"),
            ((F.col("form") == "binary") & F.coalesce(end > F.col("length"), F.lit(True)), "truncated"),
            (F.col("_rigged"), "valid_rigged_fbx"),
        ],
        "valid_fbx_rigging_unproven",
    )
    out = out.select(key, "form", version.alias("version"), "skeleton", status.alias("status"))
    return out.withColumn("valid_avatar", F.col("status") == "valid_rigged_fbx")


def summarize_meta(df: DataFrame, key: str, spec: str, c: str) -> DataFrame:
    """License fields of a model's metadata by spec: absent fields of 1.0 are restrictive, those of 0.x unknown."""
    get = lambda p: F.get_json_object(c, f"$.{p}")
    new = F.col(spec) == "1.0"
    return df.select(
        key,
        F.when(new, F.coalesce(get("avatarPermission"), F.lit("onlyAuthor"))).otherwise(get("allowedUserName")).alias("allowed_user"),
        F.when(new, F.coalesce(get("commercialUsage"), F.lit("personalNonProfit"))).otherwise(get("commercialUssageName")).alias("commercial"),
        F.when(new, F.coalesce(get("modification"), F.lit("prohibited"))).alias("modification"),
        F.when(new, get("licenseUrl")).otherwise(get("licenseName")).alias("license"),
    )
