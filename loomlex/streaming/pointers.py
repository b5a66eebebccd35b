"""Pointers to the tables of whole micro-batches: a batch counts once its pointer is there."""

from __future__ import annotations

import json
import uuid

from ..sources.xmlranges import filesystem


def put(folder: str, number: int, body: dict) -> None:
    """Names batch `number` as whole; the name is 8 digits, so that names sort as numbers do."""
    fs, at = filesystem(folder)
    fs.create_dir(at, recursive=True)
    name = f"{at}/{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(name) as out:
        out.write(json.dumps(body).encode())
    fs.move(name, f"{at}/batch-{number:08d}.json")


def held(folder: str, last: int | None = None) -> list[dict]:
    """The pointers of a folder in order of their batches, or the last few; none where there is no folder."""
    from pyarrow.fs import FileSelector

    fs, at = filesystem(folder)
    found = sorted(f.path for f in fs.get_file_info(FileSelector(at, allow_not_found=True)) if f.base_name.startswith("batch-"))
    out = []
    for path in found[-last:] if last else found:
        with fs.open_input_stream(path) as f:
            out.append(json.loads(f.read()))
    return out
