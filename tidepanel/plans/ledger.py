"""Record of experiments: one folder each, written once, and the comparison of two of them."""

from __future__ import annotations

import hashlib
import json
import math
import os
import shutil
from pathlib import Path

#: Settings that don't change what is measured.
NOT_MEASURED = frozenset({"name", "hypothesis", "model", "params"})


def fingerprint(path: str | os.PathLike) -> str:
    """SHA-256 of a local file's bytes, or of the names and bytes of a folder's files."""
    root, digest = Path(path), hashlib.sha256()
    for file in sorted(p for p in root.rglob("*") if p.is_file()) if root.is_dir() else [root]:
        digest.update(str(file.relative_to(root)).encode() + b"\0")
        with file.open("rb") as f:
            while block := f.read(1 << 20):
                digest.update(block)
    return digest.hexdigest()


def signature(settings: dict, inputs: dict[str, str], origins: list[tuple]) -> str:
    """Equal for runs whose figures can be compared: same measured settings, inputs and origins."""
    measured = {k: v for k, v in settings.items() if k not in NOT_MEASURED}
    return hashlib.sha256(json.dumps([measured, inputs, origins], sort_keys=True, default=str).encode()).hexdigest()


def _finite(x: object) -> bool:
    return isinstance(x, int | float) and math.isfinite(x)


def sound(run: dict, max_missing: float) -> bool:
    """Its inputs held still, and few of the rows to be scored lack a forecast."""
    overall = run["overall"]
    scored, missing = overall.get("n") or 0, overall.get("n_missing") or 0
    share = missing / (scored + missing) if scored + missing else float("n" in overall)
    return share <= max_missing and not run.get("inputs_changed")


def verdict(run: dict, ref: dict | None, metric: str = "wape", threshold: float = 0.01, max_missing: float = 0.05) -> tuple[str, float | None]:
    """``reference, improved, regressed, incomparable`` or ``inconclusive``, and the relative change.

    A run is better or worse only if the change passes the threshold and most folds agree.
    Runs hold ``overall`` (metric -> value), ``folds`` (fold -> value of the metric) and ``signature``.
    """
    trusted = sound(run, max_missing) and (ref is None or sound(ref, max_missing))
    if not trusted or ref is None:
        return ("reference" if trusted else "inconclusive"), None
    if run.get("signature") != ref.get("signature"):
        return "incomparable", None
    change, votes = compared(run, ref, metric)
    if change is None or abs(change) <= threshold:
        return "inconclusive", change
    better, worse = votes
    named = {(True, True): "improved", (False, True): "regressed"}
    return named.get((change < 0, (better > worse) if change < 0 else (worse > better)), "inconclusive"), change


def compared(run: dict, ref: dict, metric: str) -> tuple[float | None, tuple[int, int]]:
    """Relative change of the whole, and in how many common folds the run is below and not below the reference."""
    new, old = run["overall"].get(metric), ref["overall"].get(metric)
    change = (new - old) / abs(old) if _finite(new) and _finite(old) and old else None
    common = [(x, ref["folds"][k]) for k, x in run["folds"].items() if _finite(x) and _finite(ref["folds"].get(k))]
    below = sum(x < y for x, y in common)
    return change, (below, len(common) - below)


def reserve(ledger: str | os.PathLike, name: str) -> Path:
    """The next number's folder; making it is the lock, so two runs never share a number."""
    root = Path(ledger)
    root.mkdir(parents=True, exist_ok=True)
    number = max((int(p.name[:4]) for p in root.iterdir() if p.name[:4].isdigit()), default=0)
    while True:
        number += 1
        try:
            (root / f"{number:04d}.claim").touch(exist_ok=False)
        except FileExistsError:
            continue
        folder = root / f"{number:04d}_{name}"
        folder.mkdir()
        return folder


def release(folder: Path) -> None:
    """Give back the number of a run that failed before it was recorded."""
    if not (folder / "run.json").exists():
        shutil.rmtree(folder, ignore_errors=True)
        (folder.parent / f"{folder.name[:4]}.claim").unlink(missing_ok=True)


def latest(ledger: str | os.PathLike, name: str) -> dict | None:
    """The newest record of an experiment."""
    found = sorted(Path(ledger).glob(f"*_{name}/run.json"))
    return json.loads(found[-1].read_text()) if found else None


def record(folder: Path, settings: dict, run: dict) -> None:
    if (folder / "run.json").exists():
        raise FileExistsError(f"{folder.name} is recorded already")
    part = folder / "run.json.part"
    part.write_text(json.dumps({"settings": settings, **run}, default=str, indent=1))
    part.rename(folder / "run.json")


def leaderboard(ledger: str | os.PathLike, metric: str = "wape") -> list[tuple[str, float | None]]:
    """Recorded runs, best first, those without a figure last."""
    runs = [(p.parent.name, json.loads(p.read_text())["overall"].get(metric)) for p in Path(ledger).glob("*/run.json")]
    return sorted(((n, x if _finite(x) else None) for n, x in runs), key=lambda r: (r[1] is None, r[1] or 0.0, r[0]))
