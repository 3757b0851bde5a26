"""Archives and downloads, outside Spark: safe extraction, search, resumable fetch."""

from __future__ import annotations

import os
import shutil
import tarfile
import urllib.error
import urllib.request
import zipfile
from pathlib import Path

JUNK = ("__MACOSX", ".DS_Store", "Thumbs.db")  # litter of other systems (fixed values)


def is_junk(name: str) -> bool:
    """True if an entry's name holds any of ``JUNK``."""
    return any(junk in name for junk in JUNK)


def safe_target(base: str, name: str) -> Path:
    """Where an archive's entry goes below ``base``; raises ValueError if it would leave it."""
    root = Path(base).resolve()
    target = (root / name).resolve()
    if root != target and root not in target.parents:
        raise ValueError(f"{name} leaves the folder")
    return target


def extract(archive: str, into: str) -> int:
    """Entries of a zip or tar written below ``into``, junk left out, a single top folder lifted; returns how many files."""
    n = 0
    if zipfile.is_zipfile(archive):
        with zipfile.ZipFile(archive) as z:
            for e in z.infolist():
                if not e.is_dir() and not is_junk(e.filename):
                    n += _write(z.open(e), safe_target(into, e.filename))
    elif tarfile.is_tarfile(archive):
        with tarfile.open(archive) as t:
            for m in t:
                if m.isfile() and not is_junk(m.name):
                    n += _write(t.extractfile(m), safe_target(into, m.name))
    else:
        raise ValueError(f"{archive} is no zip or tar archive")
    lift(into)
    return n


def _write(source, target: Path) -> int:
    target.parent.mkdir(parents=True, exist_ok=True)
    with source, open(target, "wb") as f:
        shutil.copyfileobj(source, f)
    return 1


def lift(folder: str) -> None:
    """If a folder holds one folder and nothing else, that one's entries move up."""
    inner = list(Path(folder).iterdir())
    if len(inner) == 1 and inner[0].is_dir():
        aside = inner[0].rename(Path(folder) / ".lifted")
        for p in list(aside.iterdir()):
            p.rename(Path(folder) / p.name)
        aside.rmdir()


def find_archive(name: str, folders: list[str]) -> str | None:
    """An archive of that name in the first folder that has it, else one whose name holds its stem."""
    for test in (lambda p: p.name == name, lambda p: Path(name).stem.lower() in p.name.lower() and p.suffix in (".zip", ".tar", ".gz", ".tgz")):
        for d in folders:
            hits = sorted(p for p in Path(d).glob("*") if p.is_file() and test(p)) if os.path.isdir(d) else []
            if hits:
                return str(hits[0])
    return None


def fetch(url: str, path: str, block: int = 1 << 20) -> str:
    """A file fetched in a resumable way: what a ``.part`` file holds is not asked for again; it takes its name when whole."""
    part = Path(f"{path}.part")
    had = part.stat().st_size if part.exists() else 0
    request = urllib.request.Request(url, headers={"Range": f"bytes={had}-"} if had else {})
    try:
        with urllib.request.urlopen(request) as answer:  # noqa: S310
            with open(part, "ab" if had and answer.status == 206 else "wb") as f:
                shutil.copyfileobj(answer, f, block)
    except urllib.error.HTTPError as e:
        if e.code != 416:  # nothing is left to fetch
            raise
    os.replace(part, path)
    return path
