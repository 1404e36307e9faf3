"""The declared contracts. Every read and write of a catalog uses one of these, so that two shards never disagree."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = 1
# The vocabularies of the contract.
CATEGORIES = ["pwn", "web", "reverse", "crypto", "forensics", "stego", "hardware", "osint", "mobile", "blockchain", "networking", "programming", "misc", "unknown"]
ORIGINS = ["google_ctf", "hackropole", "juiceshop", "nyu_ctf_bench", "sajjadium", "pwncollege", "ctftime", "github", "picoctf", "other"]
STATUSES = ["ok", "failed", "skipped", "too_big", "staged"]

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def _struct(text: str, **more: T.DataType) -> T.StructType:
    """A struct from `name type, name type`; a type of ? is in `more`. No session is needed for it."""
    pairs = [x.split() for x in text.split(",")]
    return T.StructType([T.StructField(n, more[n] if t == "?" else _TYPES[t]) for n, t in pairs])


LICENSE = _struct("spdx_id string, name string, confidence double, redistributable boolean, source_file string, note string")
FILE = _struct("path string, sha256 string, size long, is_source boolean, lfs boolean, lfs_oid string, media_type string")
SOURCE = _struct("origin string, url string, repo string, commit_sha string, path_in_repo string, license ?, retrieved_at timestamp, is_official boolean", license=LICENSE)
WRITEUP = _struct("url string, origin string, author string, title string, text string, is_inline boolean, local_path string, rating double, language string, retrieved_at timestamp")
EVENT = _struct(
    "ctftime_event_id long, ctftime_series_id long, name string, edition string, year int, start timestamp, finish timestamp, weight double, format string, ctftime_url string, homepage string"
)


def _fields(*parts: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in parts])


_s, _i, _b, _strings = T.StringType(), T.IntegerType(), T.BooleanType(), T.ArrayType(T.StringType())
CHALLENGE = _fields(
    ("id", _s), ("title", _s), ("slug", _s), ("event", EVENT), ("event_name", _s), ("year", _i), ("category", _s), ("raw_category", _s), ("tags", _strings), ("difficulty", _s),
    ("points", _i), ("description", _s), ("flag", _s), ("flag_format", _s), ("has_source", _b), ("files", T.ArrayType(FILE)), ("solve_languages", _strings), ("docker", _b),
    ("writeups", T.ArrayType(WRITEUP)), ("sources", T.ArrayType(SOURCE)), ("license", LICENSE), ("content_fingerprint", _s), ("duplicate_of", _s), ("corpus_path", _s),
    ("ingested_at", T.TimestampType()), ("schema_version", _i),
)
RAW = _fields(
    ("origin", _s), ("title", _s), ("event_name", _s), ("edition", _s), ("year", _i), ("raw_category", _s), ("tags", _strings), ("difficulty", _s), ("points", _i), ("description", _s),
    ("flag", _s), ("local_dir", _s), ("files", T.ArrayType(FILE)), ("writeups", T.ArrayType(WRITEUP)), ("source", SOURCE), ("extra", _s),
)
CANDIDATE = _fields(
    ("full_name", _s), ("html_url", _s), ("stars", _i), ("pushed_at", T.TimestampType()), ("created_at", T.TimestampType()), ("topics", _strings), ("description", _s),
    ("license_spdx", _s), ("default_branch", _s), ("size_kb", T.LongType()), ("kind", _s),
)
SEED = _struct("pos int, section string, repo string, kind string, license string, official boolean, layout string, note string")
RESULT = _struct("repo string, commit_sha string, n_challenges int, n_files int, bytes long, status string, error string")
MANIFEST = _struct("repo string, status string, commit_sha string, n_challenges int, bytes long, ts string")
