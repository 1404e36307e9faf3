"""Acquisition on the driver: polite and guarded fetching, pinned checkouts, publishing. Everything here is off unless a
caller asks for it, and every outside call is a parameter, so that tests need no network."""

from __future__ import annotations

import ipaddress
import os
import socket
import shutil
import subprocess
import sys
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from urllib.parse import urljoin, urlparse

from pyspark import cloudpickle

MAX_BODY, MAX_REDIRECTS, MAX_FILE = 25 * 1024 * 1024, 5, 50 * 1024 * 1024
TRANSIENT = {429, 500, 502, 503, 504}
SEARCH_RETRIES, SEARCH_FLOOR, SEARCH_MAX_WAIT = 6, 2.0, 180.0
GIT_TIMEOUT, UPLOAD_TIMEOUT, UPLOAD_ATTEMPTS = 600.0, 1_800.0, 6
CRAWL_DELAY = 10.0


class UnsafeUrl(ValueError):
    pass


class RateLimiter:
    """A token bucket with a least interval between calls; acquire() returns the seconds that it slept."""

    def __init__(self, rate: float = 1.0, per: float = 1.0, burst: int = 1, min_interval: float = 0.0, clock=time.monotonic, sleep=time.sleep):
        self.rate, self.burst, self.min_interval = rate / per, float(burst), min_interval
        self.clock, self.sleep, self.lock = clock, sleep, threading.Lock()
        self.tokens, self.at, self.last = float(burst), clock(), None

    def acquire(self) -> float:
        with self.lock:
            now = self.clock()
            self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
            self.at = now
            wait = max(0.0, (1 - self.tokens) / self.rate)
            if self.last is not None:
                wait = max(wait, self.last + self.min_interval - now)
            if wait > 0:
                self.sleep(wait)
                now = self.clock()
                self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
                self.at = now
            self.tokens -= 1
            self.last = now
            return wait


def retried(call: Callable[[], tuple[int, object]], attempts: int = 5, base: float = 2.0, most: float = 60.0, sleep=time.sleep) -> tuple[int, object]:
    """The answer (status, body) of a call that is repeated while it is transient or raises an OSError."""
    for n in range(attempts):
        try:
            status, body = call()
            if status not in TRANSIENT or n == attempts - 1:
                return status, body
        except OSError:
            if n == attempts - 1:
                raise
        sleep(min(most, base * 2**n))
    raise AssertionError


def search_wait(headers: dict[str, str], attempt: int, now: float) -> float:
    """Seconds to wait after a refused search: what the service says, else twice as long each time."""
    low = {k.lower(): v for k, v in headers.items()}
    if low.get("retry-after", "").isdigit():
        return min(float(low["retry-after"]), SEARCH_MAX_WAIT)
    if low.get("x-ratelimit-remaining") == "0" and low.get("x-ratelimit-reset", "").isdigit():
        return min(max(0.0, float(low["x-ratelimit-reset"]) - now) + 1, SEARCH_MAX_WAIT)
    return min(2.0 * 2**attempt, SEARCH_MAX_WAIT)


def search_page(call: Callable[[], tuple[int, dict, dict]], sleep=time.sleep, clock=time.time, retries: int = SEARCH_RETRIES) -> tuple[int, list]:
    """(total, items) of one page. A page that stays refused counts as empty; another client error is raised."""
    for n in range(retries):
        try:
            status, headers, body = call()
        except OSError:
            sleep(min(2.0 * 2**n, SEARCH_MAX_WAIT))
            continue
        if status == 200:
            return int(body.get("total_count", 0)), list(body.get("items", []))
        if status not in (403, 429) and status < 500:
            raise ValueError(f"search answered {status}")
        sleep(search_wait(headers, n, clock()))
    return 0, []


def search(query: str, page: Callable[[str, int], tuple[int, list]], cap: int = 1_000, per_page: int = 100):
    """The results of a query, page by page, up to the cap."""
    n = 1
    while True:
        total, items = page(query, n)
        yield from items
        if not items or n * per_page >= min(total, cap):
            return
        n += 1


def is_public(address: str) -> bool:
    ip = ipaddress.ip_address(address)
    ip = getattr(ip, "ipv4_mapped", None) or ip
    return ip.is_global and not (ip.is_multicast or ip.is_reserved or ip.is_unspecified)


def check_url(url: str, resolve: Callable[[str, int], list[str]] | None = None) -> list[str]:
    """The addresses of a url that is safe to fetch; UnsafeUrl for any other."""
    found = urlparse(url)
    if found.scheme not in ("http", "https") or not found.hostname:
        raise UnsafeUrl(url)
    port = found.port or (443 if found.scheme == "https" else 80)
    try:
        hosts = resolve(found.hostname, port) if resolve else [i[4][0] for i in socket.getaddrinfo(found.hostname, port, proto=socket.IPPROTO_TCP)]
    except OSError as e:
        raise UnsafeUrl(url) from e
    if not hosts or not all(is_public(h) for h in hosts):
        raise UnsafeUrl(url)
    return hosts


def safe_get(url: str, get: Callable[[str], tuple[int, dict[str, str], object]], resolve=None, limit: int = MAX_BODY) -> tuple[int, bytes, str | None]:
    """(status, body, content type). Every redirect is checked like the first url; `get` gives the body in pieces."""
    for _ in range(MAX_REDIRECTS + 1):
        check_url(url, resolve)
        status, headers, pieces = get(url)
        low = {k.lower(): v for k, v in headers.items()}
        if status in (301, 302, 303, 307, 308) and "location" in low:
            url = urljoin(url, low["location"])
            continue
        body = bytearray()
        for piece in pieces:
            body += piece
            if len(body) > limit:
                raise UnsafeUrl(f"{url} is larger than {limit} bytes")
        return status, bytes(body), low.get("content-type")
    raise UnsafeUrl(f"more than {MAX_REDIRECTS} redirects")


class _NoRedirects(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args, **kwargs):
        return None


class Polite:
    """A client: a limiter before each call, transient answers tried again, every address checked."""

    def __init__(self, get=None, limiter: RateLimiter | None = None, resolve=None, limit: int = MAX_BODY, sleep=time.sleep):
        self.get, self.limiter, self.resolve, self.limit, self.sleep = get or urllib_get, limiter or RateLimiter(), resolve, limit, sleep

    def fetch(self, url: str) -> tuple[int, bytes, str | None]:
        def once():
            self.limiter.acquire()
            found = safe_get(url, self.get, self.resolve, self.limit)
            return found[0], found

        return retried(once, sleep=self.sleep)[1]


def urllib_get(url: str, timeout: float = 30.0) -> tuple[int, dict[str, str], list[bytes]]:
    """One GET without redirects, for safe_get; never more than MAX_BODY and a byte is read."""
    opener = urllib.request.build_opener(_NoRedirects)
    try:
        with opener.open(urllib.request.Request(url, headers={"User-Agent": "weir"}), timeout=timeout) as r:
            return r.status, dict(r.headers), [r.read(MAX_BODY + 1)]
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), []


def download(pieces, target: str, declared: int | None = None, limit: int = MAX_FILE) -> bool:
    """Writes a handout through a `.part` file that becomes the target only when whole. A target that is there and isn't
    empty is trusted; one over the limit isn't written."""
    if os.path.exists(target) and os.path.getsize(target):
        return True
    if declared is not None and declared > limit:
        return False
    part, n = f"{target}.part", 0
    try:
        with open(part, "wb") as f:
            for piece in pieces:
                n += len(piece)
                if n > limit:
                    return False
                f.write(piece)
        if declared is not None and n != declared:
            raise OSError(f"{n} of {declared} bytes")
        os.replace(part, target)
        return True
    finally:
        if os.path.exists(part):
            os.unlink(part)


def token(env: dict[str, str], run=subprocess.run) -> str | None:
    """A service token from the environment, else from the command-line tool's login. It is never logged."""
    for name in ("GITHUB_TOKEN", "GH_TOKEN"):
        if env.get(name):
            return env[name]
    try:
        out = run(["gh", "auth", "token"], capture_output=True, text=True, timeout=10)
        return out.stdout.strip() or None if out.returncode == 0 else None
    except (OSError, subprocess.SubprocessError):
        return None


def auth_headers(value: str | None) -> dict[str, str]:
    return {"Accept": "application/vnd.github+json"} | ({"Authorization": f"Bearer {value}"} if value else {})


class MirrorError(RuntimeError):
    pass


#: Bytes that must be free before a checkout begins.
DISK_FLOOR = 5 * 1024**3


def low_disk(folder: str, floor: int = DISK_FLOOR, usage=shutil.disk_usage) -> str | None:
    """Why no checkout should begin in a folder: less is free than the floor."""
    free = usage(folder).free
    return f"low disk: {free / 1024**3:.1f} GiB free, {floor / 1024**3:.1f} GiB wanted" if free < floor else None


def clone(repo: str, folder: str, run=subprocess.run, timeout: float = GIT_TIMEOUT, depth: int = 1) -> tuple[str, str]:
    """(path, commit) of a shallow checkout; one that is there is used again. Large files aren't fetched and nothing asks."""
    path = os.path.join(folder, repo.replace("/", "__", 1))
    env = os.environ | {"GIT_TERMINAL_PROMPT": "0", "GIT_LFS_SKIP_SMUDGE": "1"}

    def git(*args: str) -> str:
        try:
            out = run(["git", *args], capture_output=True, text=True, timeout=timeout, env=env)
        except (OSError, subprocess.SubprocessError) as e:
            raise MirrorError(f"{repo}: {e}") from e
        if out.returncode:
            raise MirrorError(f"{repo}: {out.stderr[-300:]}")
        return out.stdout.strip()

    if not os.path.isdir(os.path.join(path, ".git")):
        os.makedirs(folder, exist_ok=True)
        git("clone", "--depth", str(depth), f"https://github.com/{repo}.git", path)
    return path, git("-C", path, "rev-parse", "HEAD")


#: What the child of an upload runs: a pickled function comes in, a pickled answer goes out.
_CHILD = """import sys
from pyspark import cloudpickle
out, sys.stdout = sys.stdout.buffer, sys.stderr
try:
    said = ("ok", cloudpickle.loads(sys.stdin.buffer.read())())
except BaseException as e:
    said = ("error", f"{type(e).__name__}: {e}")
out.write(cloudpickle.dumps(said))
"""


def upload(publish: Callable[[], str], attempts: int = UPLOAD_ATTEMPTS, deadline: float = UPLOAD_TIMEOUT, sleep=time.sleep) -> str:
    """Runs an upload in a child process that is ended at the deadline, again if need be. The child is a new interpreter, so
    nothing of this one's threads is in it."""
    last = "no attempt"
    for n in range(attempts):
        child = subprocess.Popen([sys.executable, "-c", _CHILD], stdin=subprocess.PIPE, stdout=subprocess.PIPE, env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)})
        try:
            said = child.communicate(cloudpickle.dumps(publish), timeout=deadline)[0]
            kind, last = cloudpickle.loads(said) if said else ("error", f"the child ended with {child.returncode}")
        except subprocess.TimeoutExpired:
            child.kill()
            child.communicate()
            kind, last = "error", f"no answer in {deadline} s"
        if kind == "ok":
            return last
        if n < attempts - 1:
            sleep(min(60, 2**n))
    raise RuntimeError(f"upload failed: {last}")


def publish(folder: str, dataset: str, send: Callable[[str, str], str] | None = None, dry_run: bool = True, only: str | None = None) -> str:
    """Says what would be published, or sends it. only: a suffix that files must have. An empty folder is not sent."""
    names = [os.path.join(d, n) for d, _, ns in os.walk(folder) for n in ns if not os.path.islink(os.path.join(d, n)) and (only is None or n.endswith(only))]
    if not names:
        return f"nothing to publish in {folder}"
    said = f"{len(names)} files, {sum(map(os.path.getsize, names))} bytes to {dataset}"
    if dry_run:
        return f"dry run: {said}"
    if send is None:
        raise ValueError("no way to send")
    return upload(lambda: send(folder, dataset))
