"""Scalar functions on names, paths, identifiers and numbers."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, StructType

# Parts that a joint's name may lose before names are compared.
JOINT_PARTS = ("observation", "state", "action", "target", "command", "position", "pos")
# Parts of a name by which a place of a vector is a gripper's.
GRIPPER_PARTS = ("gripper", "finger", "jaw")
# Cameras in the order in which a primary one is chosen, and parts of names that come next.
FIRST_CAMERAS = ("observation.images.front", "front", "external_camera", "cam_high")
FRONT_PARTS = ("front", "external", "cam_high")


def joint_name(name: Column) -> Column:
    """A joint's name for comparison: lower case, common parts and marks removed.

    Null for generic names (state_3, action_3), which say nothing about what they measure, and where nothing or only
    digits remain.
    """
    low, marks = F.lower(name), r"[^\p{L}\p{N}]"
    bare = low
    for part in JOINT_PARTS:
        bare = F.replace(bare, F.lit(part), F.lit(""))
    bare = F.regexp_replace(bare, marks, "")
    generic = F.regexp_replace(low, marks, "").rlike(r"^(state(action)?|action)\p{N}+$")
    return F.when(~generic & (F.length(bare) > 0) & ~bare.rlike(r"^\p{N}+$"), bare)


def is_gripper(name: Column) -> Column:
    return F.coalesce(F.lower(name).rlike("|".join(GRIPPER_PARTS)), F.lit(False))


def uid_part(value: Column) -> Column:
    """A piece of an identifier: other characters than letters, digits, dot, underscore and dash become one dash."""
    slug = F.regexp_replace(value, r"[^A-Za-z0-9._-]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(slug, r"^[-._]+|[-._]+$", ""), F.lit("")), F.lit("dataset"))


def identity_hash(path: Column, length: int) -> Column:
    return F.substring(F.sha2(path, 256), 1, length)


def dataset_uid(root: Column, explicit: Column | None = None, longest: int = 180) -> Column:
    """The explicit identifier, else the path's parts joined by two dashes; long ones end in a hash of the path."""
    joined = F.array_join(F.transform(F.filter(F.split(root, "/"), lambda p: p != ""), uid_part), "--")
    made = F.when(F.length(joined) <= longest, joined).otherwise(F.concat(F.substring(joined, 1, longest), F.lit("-"), identity_hash(root, 8)))
    return F.coalesce(F.nullif(explicit, F.lit("")), made) if explicit is not None else made


def safe_id(uid: Column) -> Column:
    return F.replace(uid, F.lit("/"), F.lit("__"))


def search_text(collection: Column, uid: Column, task: Column, instruction: Column, episode: Column) -> Column:
    """What a search looks into, in lower case; missing parts are left out."""
    return F.lower(F.concat_ws(" ", collection, uid, task, instruction, F.concat(F.lit("episode "), episode.cast("string"))))


def video_path(camera: Column, chunk: Column, file: Column) -> Column:
    return F.format_string("videos/%s/chunk-%03d/file-%03d.mp4", camera, chunk, file)


def nested(document: Column, path: str) -> Column:
    """Text of a value inside a JSON document by a dotted or slashed path; null where it is missing or unreadable."""
    keys = [k for k in path.replace("/", ".").split(".") if k]
    return F.try_variant_get(F.try_parse_json(document), "$" + "".join(f"['{k}']" for k in keys), "string")


def relative_difference(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1e-12))


def lossless(value: Column, kind: str, source: str) -> Column:
    """The value in another type if casting back gives it again, else null."""
    cast = value.try_cast(kind)
    return F.when(cast.try_cast(source).eqNullSafe(value), cast)


def close(a: Column, b: Column, rtol: float = 1e-6, atol: float = 1e-8) -> Column:
    """Equal within tolerances; NaN equals NaN, null equals null."""
    both = F.isnan(a) & F.isnan(b)
    near = ~F.isnan(a) & ~F.isnan(b) & ((a == b) | (F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)))
    return F.coalesce(both | near, a.isNull() & b.isNull())


def close_values(a: Column, b: Column, kind: DataType, rtol: float = 1e-6, atol: float = 1e-8) -> Column:
    """The same for values of any type: floats within tolerances, arrays and structs part by part, all else equal; null equals null."""
    if isinstance(kind, (FloatType, DoubleType)):
        return close(a, b, rtol, atol)
    if isinstance(kind, ArrayType):
        parts = F.forall(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: close_values(x["a"], x["b"], kind.elementType, rtol, atol))
        return F.coalesce((F.size(a) == F.size(b)) & parts, a.isNull() & b.isNull())
    if isinstance(kind, StructType):
        out = a.isNull() == b.isNull()
        for f in kind:
            out = out & (a.isNull() | close_values(a[f.name], b[f.name], f.dataType, rtol, atol))
        return out
    return a.eqNullSafe(b)


def psnr(mean_square: Column) -> Column:
    """Decibels for pixel values to 255; 100 where nothing differs."""
    return F.when(mean_square == 0, F.lit(100.0)).otherwise(20 * F.log10(F.lit(255.0) / F.sqrt(mean_square)))


def iou(both: Column, either: Column) -> Column:
    """Overlap by union; 0 where the union is empty."""
    return F.coalesce(F.try_divide(both.cast("double"), either.cast("double")), F.lit(0.0))


def natural_key(path: Column) -> Column:
    """Sorts as people do: each run of digits becomes a fixed width."""
    padded = F.regexp_replace(path, r"(\d+)", "0000000000000000000$1")
    return F.regexp_replace(padded, r"0*(\d{19})(?!\d)", "$1")


def primary_camera(cameras: Column) -> Column:
    """The camera to show: a well-known one, else a front view, else a colour view that is neither a wrist's nor of
    depth, else any but a wrist's, else the first. Letter case is ignored; of equal names the last is taken."""
    def rank(low: Column) -> Column:
        known = F.array_position(F.lit(list(FIRST_CAMERAS)), low)
        colour = ~F.contains(low, F.lit("wrist")) & low.rlike("rgb|image") & ~F.contains(low, F.lit("depth"))
        front = low.rlike("|".join(FRONT_PARTS))
        return F.when(known > 0, known - 10).when(front, 1).when(colour, 2).when(~F.contains(low, F.lit("wrist")), 3).otherwise(4).cast("int")

    def entry(c: Column, i: Column) -> Column:
        r = rank(F.lower(c))
        return F.struct(r.alias("rank"), F.when(r < 0, -i).otherwise(i).alias("place"), c.alias("camera"))

    return F.array_min(F.transform(cameras, entry))["camera"]


def etag(row: Sequence[Column], length: int = 16) -> Column:
    """A short digest of a row's values, null apart from every text."""
    return F.substring(F.sha2(F.to_json(F.array(*(c.cast("string") for c in row)), {"ignoreNullFields": "false"}), 256), 1, length)


def action_layout(action: Column, base: Column) -> Column:
    """What an action of two arms (14 places) with a mobile base (2 more) holds: arms, arms_and_base, base_differs or unknown.

    A base that comes apart must equal the last two places, within 1e-6 and a part in 1e5 of the separate one.
    """
    near = F.forall(F.zip_with(F.slice(action, 15, 2), base, lambda x, y: close(x, y, rtol=1e-5, atol=1e-6)), lambda x: x)
    wide = F.when(base.isNull() | near, "arms_and_base").otherwise("base_differs")
    return F.when(F.size(action) == 14, "arms").when(F.size(action) == 16, wide).otherwise("unknown")


def series_fields(names: Column) -> Column:
    """Numeric fields to plot: states, then actions, the whole vectors before their parts, else by name."""
    whole = F.array(F.lit("observation.state"), F.lit("action"), F.lit("actions"))

    def side(fits: Callable[[Column], Column]) -> Column:
        rank = lambda n: F.when(n.isin("observation.state", "action"), 0).when(n == "actions", 1).otherwise(2)
        ranked = F.array_sort(F.transform(F.filter(names, fits), lambda n: F.struct(rank(n).alias("rank"), n.alias("name"))))
        return F.transform(ranked, lambda x: x["name"])

    states = side(lambda n: (n == whole[0]) | n.startswith("observation.state."))
    return F.concat(states, side(lambda n: F.array_contains(F.slice(whole, 2, 2), n) | n.startswith("action.") | n.startswith("actions.")))


#: Bytes that stay free on a disk at least, and the part of it.
RESERVE_BYTES, RESERVE_PART = 200 << 30, 0.15


def storage_needs(disk: int, free: int, source: int, output: int, staged: int) -> dict[str, int | bool]:
    """What a conversion needs at its peak, what must stay free, and whether both fit."""
    reserve, peak = max(RESERVE_BYTES, int(disk * RESERVE_PART)), source + output + staged
    return {"reserve": reserve, "peak": peak, "missing": max(0, peak + reserve - free), "fits": peak + reserve <= free}


def duration_text(seconds: float | None) -> str:
    """Hours, minutes and seconds as 1:02:03; unknown ones as --:--."""
    if seconds is None or seconds != seconds or seconds < 0 or seconds == float("inf"):
        return "--:--"
    minutes, s = divmod(int(seconds), 60)
    hours, m = divmod(minutes, 60)
    return f"{hours}:{m:02d}:{s:02d}" if hours else f"{m:02d}:{s:02d}"


def remaining_seconds(done: float, total: float, elapsed: float) -> float | None:
    """Time that the rest takes at the rate so far; None before anything is done."""
    return elapsed * (total - done) / done if done > 0 and elapsed > 0 else None


def canonical_json_text(value: object) -> str:
    """Sorted keys, no blanks, no NaN: one text for one value."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def fingerprint(value: object) -> str:
    return hashlib.sha256(canonical_json_text(value).encode()).hexdigest()


def resume_fingerprint(value: object, ignore: Sequence[str]) -> str:
    """The same without keys, at any depth, that may differ between runs of one job (paths, worker counts)."""
    def bare(x: object) -> object:
        if isinstance(x, Mapping):
            return {k: bare(v) for k, v in x.items() if k not in set(ignore)}
        return [bare(v) for v in x] if isinstance(x, (list, tuple)) else x

    return fingerprint(bare(value))


def merge_layers(*layers: Mapping) -> dict:
    """Later layers over earlier ones; mappings are merged key by key, everything else is replaced."""
    out: dict = {}
    for layer in layers:
        for k, v in layer.items():
            out[k] = merge_layers(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out
