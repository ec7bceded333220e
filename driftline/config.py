"""Configuration: a YAML file, overridden by the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import fields
from pathlib import Path

import yaml

from driftline.sources.manifest import ManifestOptions

#: Keys of the llm section that the environment overrides, as LLM_<KEY>.
LLM_KEYS = {"backend": str, "base_url": str, "api_key": str, "model": str, "max_tokens": int, "batch_size": int, "max_concurrent": int, "timeout": int, "api_version": str}
LLM_DEFAULTS = {"backend": "openai", "skip_changed": True, "batch_size": 20, "max_concurrent": 5, "timeout": 180, "max_tokens": 4096, "api_version": "2023-06-01"}
#: scripts: fetched files; primary, fallback: earlier packages; tables: YAML tables; work: items, checkpoint and snapshot.
PATHS = {"scripts": "cache/server", "primary": "cache/primary", "fallback": "cache/fallback", "tables": "cache/tables", "work": "cache", "output": "output"}


def load_config(path: str | Path, environ: Mapping[str, str] = os.environ) -> dict:
    """The file's sections with defaults: llm, paths, packages, manifest, character_names."""
    path = Path(path)
    found = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    llm = LLM_DEFAULTS | (found.get("llm") or {})
    for key, cast in LLM_KEYS.items():
        text = environ.get(name := f"LLM_{key.upper()}")
        if text is not None:
            try:
                llm[key] = cast(text)
            except ValueError as e:
                raise ValueError(f"{name} has a wrong value: {text!r}") from e
    known = {f.name for f in fields(ManifestOptions)}
    options = {k: str(v) if isinstance(v, int) and k != "app_id" else v for k, v in (found.get("manifest") or {}).items() if k in known}
    return {"llm": llm, "paths": resolve_paths(found.get("paths") or {}, path.parent), "packages": {"use_fallback": True} | (found.get("packages") or {}), "manifest": ManifestOptions(**options), "names": {str(k): v or "" for k, v in (found.get("character_names") or {}).items()}}


def resolve_paths(configured: Mapping[str, str], root: Path) -> dict[str, str]:
    """Absolute paths; URIs stay as they are."""
    chosen = {k: str(configured.get(k, default)) for k, default in PATHS.items()}
    return {k: p if "://" in p else str(Path(root).resolve() / p) for k, p in chosen.items()}


def validate_llm(llm: Mapping) -> None:
    """An error before any call if a connection setting is missing."""
    lacking = [k for k in ("base_url", "api_key", "model") if not llm.get(k)]
    if lacking:
        raise ValueError(f"llm settings missing: {', '.join(lacking)}; set them in the file or as LLM_ variables")
