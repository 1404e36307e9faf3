"""Path classification of source trees: what is noise, an artifact or a component, and what the segments of a path tell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.text import CATEGORY_LABELS, category, suffix

# Names and suffixes by which directories and files are told apart.
NOISE = [
    ".git", ".github", ".gitlab", "node_modules", "__pycache__", ".idea", ".vscode", "venv", ".venv", ".pytest_cache", ".ruff_cache",
    "third_party", "third-party", "thirdparty", "vendor", "vendored", "kctf",
]
COMPONENTS = [
    "public", "private", "src", "source", "sources", "dist", "handout", "handouts", "deploy", "deployment", "solution", "solutions", "solve", "solver",
    "writeup", "writeups", "exploit", "exploits", "poc", "setup", "service", "server", "client", "app", "bin", "build", "files", "attachments", "share",
    "upload", "uploads", "release", "docker", "challenge", "healthcheck", "health-check", "metadata", "sample", "samples", "sol", "sols", "resources", "static",
]
ROOT_MARKERS = ["attachments", "challenge", "healthcheck", "health-check", "solution", "solutions"]
WRAPPERS = ["ctfs", "challenges", "challenge", "chall", "chals", "tasks"]
EDITIONS = ["quals", "qualifiers", "finals", "final", "onsite"]
SOURCE_SUFFIXES = [".py", ".c", ".cpp", ".cc", ".rs", ".go", ".js", ".php", ".sol", ".s"]
HANDOUT_SUFFIXES = [".gz", ".tgz", ".zip", ".xz", ".bz2", ".7z"]
NAME_TOKENS = {k: k for k in CATEGORY_LABELS if " " not in k} | {"re": "reverse", "hw": "hardware"}
ORIGIN_BY_REPO = {"google/google-ctf": "google_ctf"}
ORIGIN_BY_OWNER = {"google": "google_ctf", "sajjadium": "sajjadium", "pwncollege": "pwncollege", "nyu-llm-ctf": "nyu_ctf_bench"}
WRITEUP_WORDS = ["writeup", "write-up", "write-ups", "writeups"]
SOURCE_WORDS = ["ctf-challenges", "challenges", "challenge", "tasks", "source"]


def is_noise(name: Column) -> Column:
    return name.isin(NOISE) | name.startswith(".git")


def has_noise(path: Column) -> Column:
    """Whether any directory of a path is noise."""
    return F.exists(F.split(path, "/"), is_noise)


def is_docker_file(name: Column) -> Column:
    low = F.lower(name)
    return (low == "dockerfile") | low.startswith("docker-compose") | (low == "compose.yaml")


def is_source_name(name: Column) -> Column:
    return suffix(name).isin(SOURCE_SUFFIXES)


def is_handout(name: Column) -> Column:
    return F.lower(name).endswith(".tar.gz") | suffix(name).isin(HANDOUT_SUFFIXES)


def is_artifact(name: Column) -> Column:
    return is_docker_file(name) | is_source_name(name) | is_handout(name)


def is_component(name: Column) -> Column:
    return F.lower(name).isin(COMPONENTS)


def is_root_marker(name: Column) -> Column:
    return F.lower(name).isin(ROOT_MARKERS)


def year_of(segment: Column) -> Column:
    """The first token of four digits from 1990 to 2099."""
    tokens = F.filter(F.split(segment, r"[-_\s]+"), lambda t: t.rlike("^(199[0-9]|20[0-9]{2})$"))
    return F.try_element_at(tokens, F.lit(1)).try_cast("int")


def category_of_name(name: Column) -> Column:
    """The first whole token of a name that is a category word."""
    words = F.create_map(*[F.lit(x) for kv in NAME_TOKENS.items() for x in kv])
    found = F.transform(F.split(F.lower(name), r"[-_\s]+"), lambda t: F.try_element_at(words, t))
    return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(1))


def origin_of_repo(repo: Column) -> Column:
    exact = F.create_map(*[F.lit(x) for kv in ORIGIN_BY_REPO.items() for x in kv])
    owner = F.create_map(*[F.lit(x) for kv in ORIGIN_BY_OWNER.items() for x in kv])
    return F.coalesce(F.try_element_at(exact, repo), F.try_element_at(owner, F.lower(F.split_part(repo, F.lit("/"), F.lit(1)))), F.lit("github"))


def kind_of_repo(name: Column, description: Column, topics: Column) -> Column:
    """writeups, sources or unknown, by words in name, description and topics; the first named goes first."""
    hay = F.lower(F.concat_ws(" ", name, F.coalesce(description, F.lit("")), F.array_join(F.coalesce(topics, F.array().cast("array<string>")), " ")))
    quoted = lambda words: "|".join(words)  # noqa: E731  no word has a character that a pattern reads otherwise
    return F.when(hay.rlike(quoted(WRITEUP_WORDS)), "writeups").when(hay.rlike(quoted(SOURCE_WORDS)), "sources").otherwise("unknown")


def _index(array: Column, holds, last: bool = False) -> Column:
    """The place, from 0, of the first or last element that holds; null without one."""
    places = F.filter(F.transform(array, lambda x, i: F.when(holds(x), i)), lambda i: i.isNotNull())
    return F.try_element_at(places, F.lit(-1 if last else 1))


def derive(df: DataFrame, segments: str, meta_name: str, meta_category: str) -> DataFrame:
    """df with title, event_name, edition, year and raw_category of a challenge directory's path segments. What the
    directory's own metadata names goes first; of the ancestors, the first year, the last edition and the last category
    count, and the event is the first segment that is neither of them nor a wrapper.

    The places are columns of their own, so that each is computed once however often it is used.
    """
    up = F.slice(segments, F.lit(1), F.greatest(F.size(segments) - 1, F.lit(0)))
    at = df.withColumn("__up", up).withColumns(
        {
            "__year": _index(F.col("__up"), lambda s: year_of(s).isNotNull()),
            "__edition": _index(F.col("__up"), lambda s: F.lower(s).isin(EDITIONS), last=True),
            "__category": _index(F.col("__up"), lambda s: category(s) != "unknown", last=True),
            "__leaf": F.try_element_at(segments, F.lit(-1)),
        }
    )
    used = F.filter(F.array("__year", "__edition", "__category"), lambda i: i.isNotNull())
    rest = F.filter("__up", lambda s, i: ~F.array_contains(used, i) & ~F.lower(s).isin(WRAPPERS))
    made = at.withColumns(
        {
            "title": F.coalesce(F.nullif(F.col(meta_name), F.lit("")), "__leaf", F.lit("unknown")),
            "event_name": F.try_element_at(rest, F.lit(1)),
            "edition": F.get("__up", F.col("__edition")),
            "year": year_of(F.get("__up", F.col("__year"))),
            "raw_category": F.nullif(F.coalesce(F.col(meta_category), F.get("__up", F.col("__category")), category_of_name(F.col("__leaf"))), F.lit("")),
        }
    )
    return made.drop("__up", "__year", "__edition", "__category", "__leaf")
