"""Column builders that turn loose text into canonical values."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labels and the categories they mean. Of equally long labels that a text contains, the one listed first counts.
CATEGORY_LABELS = {
    "pwn": "pwn", "binary exploitation": "pwn", "binary": "pwn", "exploitation": "pwn", "web exploitation": "web", "web": "web",
    "reverse engineering": "reverse", "reversing": "reverse", "reverse": "reverse", "rev": "reverse", "cryptography": "crypto", "crypto": "crypto",
    "forensics": "forensics", "forensic": "forensics", "steganography": "stego", "stego": "stego", "hardware": "hardware", "osint": "osint",
    "mobile": "mobile", "android": "mobile", "blockchain": "blockchain", "smart contract": "blockchain", "networking": "networking", "network": "networking",
    "programming": "programming", "ppc": "programming", "misc": "misc", "miscellaneous": "misc", "injection": "web", "xss": "web",
    "cross site scripting": "web", "broken access control": "web", "broken authentication": "web", "sensitive data exposure": "web",
    "security misconfiguration": "web", "vulnerable components": "web", "improper input validation": "web", "insecure deserialization": "web", "xxe": "web",
    "server side request forgery": "web", "ssrf": "web", "unvalidated redirects": "web", "forgotten content": "web",
    "security through obscurity": "misc", "cryptographic issues": "crypto",
}
# Source suffixes and languages, names of container files, names that aren't source.
SOURCE_LANGUAGES = {
    ".py": "python", ".c": "c", ".h": "c", ".cpp": "cpp", ".cc": "cpp", ".rs": "rust", ".go": "go", ".js": "javascript", ".ts": "typescript",
    ".php": "php", ".rb": "ruby", ".java": "java", ".sol": "solidity", ".asm": "asm", ".s": "asm", ".sh": "shell",
}
DOCKER_NAMES = ["dockerfile", "docker-compose.yml", "docker-compose.yaml", "compose.yaml"]
NON_SOURCE = r"(?i)^(readme(\..*)?|writeups?(\..*)?|solve[rs]?(\..*)?|solutions?(\..*)?|\.git.*|\.ds_store)$"


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(text: Column) -> Column:
    """Compatibility composition. Plain ASCII stays in the JVM: only other texts are handed to Python."""
    return F.coalesce(_nfkc(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def slug_of_normal(text: Column) -> Column:
    """The slug of a text that is in compatibility form already."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "-"), "^-+|-+$", "")


def slug(text: Column) -> Column:
    """Lower case, with one hyphen for each run of what is neither letter nor digit; empty if nothing else is there."""
    return slug_of_normal(nfkc(text))


def category(label: Column) -> Column:
    """The category of the longest label that a text contains; `unknown` if there is none."""
    low = F.lower(label)
    out = F.lit("unknown")
    # the chain is asked from the longest on, and from the first listed of equal ones
    for key in reversed(sorted(CATEGORY_LABELS, key=lambda k: -len(k))):
        out = F.when(F.contains(low, F.lit(key)), CATEGORY_LABELS[key]).otherwise(out)
    return out


def challenge_id(event: Column, year: Column, title: Column, category_: Column, slugged=slug) -> Column:
    """24 hex digits of a hash over event, year, title and category. A title without a slug counts by its own hash, so that
    no two titles fall together."""
    by_title = F.coalesce(F.nullif(slugged(title), F.lit("")), F.concat(F.lit("h:"), F.substring(F.sha2(title, 256), 1, 16)))
    basis = F.concat_ws(
        "|",
        slugged(F.coalesce(F.nullif(event, F.lit("")), F.lit("unknown-event"))),
        F.coalesce(F.nullif(year, F.lit(0)).cast("string"), F.lit("0000")),
        by_title,
        F.lower(F.coalesce(F.nullif(category_, F.lit("")), F.lit("unknown"))),
    )
    return F.substring(F.sha2(basis, 256), 1, 24)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)/*$", 1)


def suffix(path: Column) -> Column:
    """The last suffix in lower case; none for a name that only begins or ends with a point."""
    return F.lower(F.regexp_extract(basename(path), r"^.*[^/](\.[^.]+)$", 1))


def is_source(path: Column) -> Column:
    return ~basename(path).rlike(NON_SOURCE)


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def solve_languages(files: Column) -> Column:
    """Sorted distinct languages of the source files."""
    known = F.transform(F.filter(files, lambda f: f["is_source"]), lambda f: F.try_element_at(_map(SOURCE_LANGUAGES), suffix(f["path"])))
    return F.array_sort(F.array_distinct(F.filter(known, lambda x: x.isNotNull())))


def has_docker(files: Column) -> Column:
    return F.exists(files, lambda f: F.lower(basename(f["path"])).isin(DOCKER_NAMES))


def has_source(files: Column) -> Column:
    return F.exists(files, lambda f: f["is_source"])


def fingerprint(files: Column) -> Column:
    """A hash over path and content of the source files in path order; null without any."""
    anchors = F.transform(
        F.filter(files, lambda f: f["is_source"]),
        lambda f: F.struct(f["path"].alias("p"), F.coalesce(F.nullif(f["sha256"], F.lit("")), F.nullif(f["lfs_oid"], F.lit("")), F.concat(F.lit("lfs:"), f["size"].cast("string"))).alias("a")),
    )
    lines = F.transform(F.array_sort(anchors), lambda x: F.concat(x["p"], F.lit(":"), x["a"]))
    return F.when(F.size(lines) > 0, F.sha2(F.array_join(lines, "\n"), 256))


def near_tokens(text: Column) -> Column:
    """Lower-case word tokens without line comments."""
    bare = F.when(F.contains(text, F.lit("#")) | F.contains(text, F.lit("//")), F.regexp_replace(text, r"(?m)(#|//).*?$", "")).otherwise(text)
    return F.regexp_extract_all(F.lower(bare), F.lit("[A-Za-z0-9_]+"), F.lit(0))


#: The permutations of a signature are x -> (a * x + b) modulo this prime; a and b come from powers of one of its primitive roots.
PRIME, ROOT = 2**31 - 1, 48_271


def token_hash(token: Column) -> Column:
    """60 bits of a token's md5."""
    return F.conv(F.substring(F.md5(token.cast("binary")), 1, 15), 16, 10).cast("long")


def token_set(tokens: Column) -> Column:
    """The ascending token_hash of each distinct token; null for null."""
    return F.sort_array(F.transform(F.array_distinct(tokens), token_hash))  # array_sort would ask an expression for each two


def permutation(i: int) -> tuple[int, int]:
    """The numbers a and b of the i-th permutation."""
    return pow(ROOT, 2 * i + 1, PRIME), pow(ROOT, 2 * i + 2, PRIME)


#: Hashes that are permuted at a time, so that they stay in a core's cache.
BLOCK = 1 << 15


def _permuted(flat: np.ndarray, a: int, b: int) -> np.ndarray:
    """(a * flat + b) modulo PRIME, a power of two less one: what lies above 31 bits is added to what lies below, without a division."""
    x = flat * a
    x += b
    for _ in range(2):  # below 2 ** 32, then PRIME + 1 at most
        high = x >> 31
        x &= PRIME
        x += high
    x[x >= PRIME] -= PRIME
    return x


def signature(hashes: Column, permutations: int = 128) -> Column:
    """The least value of a set of token hashes under each permutation; null for none. All sets of a batch are permuted at once."""

    def run(batch: pa.Array) -> pa.Array:
        counts = np.diff(batch.offsets.to_numpy()) if len(batch) else np.empty(0, np.int64)
        counts[batch.is_null().to_numpy(zero_copy_only=False)] = 0
        flat, some = batch.flatten().to_numpy() % PRIME, counts > 0
        starts = np.concatenate([[0], np.cumsum(counts[some])[:-1]]).astype(np.int64)
        out = np.empty((int(some.sum()), permutations), np.int64)
        ends, numbers, row = np.append(starts[1:], len(flat)), [permutation(i) for i in range(permutations)], 0
        while row < len(out):  # whole sets, one at least
            to = max(row + 1, int(np.searchsorted(ends, starts[row] + BLOCK, "right")))
            some_hashes, at = flat[starts[row] : ends[to - 1]], starts[row:to] - starts[row]
            for i, (a, b) in enumerate(numbers):
                out[row:to, i] = np.minimum.reduceat(_permuted(some_hashes, a, b), at)
            row = to
        offsets = np.concatenate([[0], np.cumsum(some)]).astype(np.int32) * permutations
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.reshape(-1)), mask=pa.array(~some))

    run.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<long>")(hashes)


def minhash(tokens: Column, permutations: int = 128) -> Column:
    """The signature of a set of tokens; null for none."""
    return signature(F.transform(F.array_distinct(tokens), token_hash), permutations)


def first_int(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"-?\d+", 0), F.lit("")).try_cast("int")


def first_float(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"-?\d+(?:\.\d+)?", 0), F.lit("")).try_cast("double")


def link_id(href: Column) -> Column:
    """The number of a task, writeup or team link."""
    return F.nullif(F.regexp_extract(href, r"/(?:task|writeup|team)/(\d+)", 1), F.lit("")).try_cast("long")


def timestamp(text: Column) -> Column:
    return F.try_to_timestamp(F.nullif(text, F.lit("")))


def epoch(text: Column) -> Column:
    return F.unix_timestamp(timestamp(text))


def tags(text: Column) -> Column:
    """A comma-separated text as trimmed tags without blanks; none for null."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def pick_category(tags_: Column) -> Column:
    """The first tag with a known category, else the first tag."""
    return F.coalesce(F.try_element_at(F.filter(tags_, lambda t: category(t) != "unknown"), F.lit(1)), F.try_element_at(tags_, F.lit(1)))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_slug(url: Column) -> Column:
    """The last segment of a url's path."""
    return F.regexp_extract(url_path(url), "([^/]*)/*$", 1)


def url_category(url: Column) -> Column:
    """The segment between `challenges` and the slug, if there is one."""
    parts = F.filter(F.split(url_path(url), "/"), lambda x: x != "")
    at = F.array_position(parts, "challenges").cast("int")
    return F.when((at > 0) & (at < F.size(parts) - 1), F.try_element_at(parts, at + 1))


def sitemap_url(base: Column, lang: Column) -> Column:
    return F.format_string("%s/%s/sitemap.xml", base, lang)


def writeup_origin(url: Column) -> Column:
    return F.when(F.contains(F.lower(url), F.lit("github.com")), "github").otherwise("other")


# Content types and suffixes of writeups.
CONTENT_TYPES = {"text/html": ".html", "text/markdown": ".md", "text/plain": ".txt", "application/pdf": ".pdf", "application/json": ".json"}


def writeup_suffix(url: Column, content_type: Column) -> Column:
    by_type = F.try_element_at(_map(CONTENT_TYPES), F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1)))))
    own = suffix(F.split_part(url, F.lit("?"), F.lit(1)))
    by_url = F.when(own == ".htm", ".html").when(own.isin(".html", ".md", ".txt", ".pdf", ".json"), own)
    return F.coalesce(by_type, by_url, F.lit(".html"))


def repo_dirname(repo: Column) -> Column:
    """owner/name as owner__name."""
    return F.regexp_replace(repo, "^([^/]*)/", "$1__")


def midpoint(low: Column, high: Column, dates: bool = False) -> Column:
    """The middle of a range, rounded down: of dates or of integers."""
    return F.date_add(low, F.floor(F.date_diff(high, low) / 2).cast("int")) if dates else F.shiftright((low + high).cast("long"), 1)


def page_count(cap: Column, per_page: Column) -> Column:
    return F.ceil(cap / per_page)


def backoff(attempt: Column, base: float = 2.0, most: float = 180.0) -> Column:
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt))
