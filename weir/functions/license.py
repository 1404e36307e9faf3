"""License detection and the redistribution gate, as column builders."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from weir.schema import LICENSE

# Identifiers that may be redistributed, and marker patterns in the order in which they are asked.
REDISTRIBUTABLE = [
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense", "WTFPL", "0BSD", "etalab-2.0",
]
MARKERS = [
    ("GNU AFFERO GENERAL PUBLIC LICENSE.*Version 3", "AGPL-3.0-or-later"),
    ("GNU GENERAL PUBLIC LICENSE.*Version 3", "GPL-3.0-or-later"),
    ("GNU GENERAL PUBLIC LICENSE.*Version 2", "GPL-2.0-or-later"),
    ("GNU LESSER GENERAL PUBLIC LICENSE.*Version 3", "LGPL-3.0-or-later"),
    (r"Apache License.*Version 2\.0", "Apache-2.0"),
    (r"Mozilla Public License Version 2\.0", "MPL-2.0"),
    ("Permission is hereby granted, free of charge.*MIT", "MIT"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "MIT"),
    ("Redistribution and use in source and binary forms.*neither the name", "BSD-3-Clause"),
    ("Redistribution and use in source and binary forms", "BSD-2-Clause"),
    ("This is free and unencumbered software released into the public domain", "Unlicense"),
    ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE", "WTFPL"),
    ("Licence Ouverte|Open Licence|etalab", "etalab-2.0"),
    (r"Creative Commons Attribution-ShareAlike 4\.0", "CC-BY-SA-4.0"),
    (r"Creative Commons Attribution 4\.0", "CC-BY-4.0"),
    (r"CC0 1\.0 Universal", "CC0-1.0"),
]
HEAD = 4_000
TEXT_CONFIDENCE = 0.75
UNRECOGNIZED = "license file present but unrecognized"


def redistributable(spdx: Column) -> Column:
    return F.coalesce(spdx.isin(REDISTRIBUTABLE), F.lit(False))


def _info(spdx: Column, confidence: Column, source_file: Column, note: Column) -> Column:
    values = {"spdx_id": spdx, "name": F.lit(None), "confidence": confidence, "redistributable": redistributable(spdx), "source_file": source_file, "note": note}
    return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in LICENSE])


def unknown(note: Column | None = None, source_file: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return _info(none, F.lit(0.0), none if source_file is None else source_file, none if note is None else note)


def from_spdx(spdx: Column, confidence: float = 1.0, note: Column | None = None) -> Column:
    """The license that an identifier names; none for null, empty, NOASSERTION or NONE, whose note is kept."""
    none = F.lit(None).cast("string")
    named = spdx.isNotNull() & ~F.upper(spdx).isin("", "NOASSERTION", "NONE")
    return F.when(named, _info(spdx, F.lit(confidence), none, none if note is None else note)).otherwise(unknown(note))


def _folded(pattern: str) -> str:
    """A marker whose k and s also match the Kelvin sign and the long s, which fold to them in SQL and in the reference; Java folds
    ASCII alone, and by (?u) also the dotless i, which SQL doesn't."""
    return re.sub(r"\\.|[KkSs]", lambda m: {"k": "[k\u212a]", "s": "[s\u017f]"}.get(m[0].lower(), m[0]), pattern)


def spdx_of_text(text: Column) -> Column:
    """The identifier of the first marker in a text's head; null without one."""
    head, out = F.substring(text, 1, HEAD), F.lit(None).cast("string")
    for pattern, spdx in reversed(MARKERS):
        out = F.when(head.rlike(f"(?is){_folded(pattern)}"), spdx).otherwise(out)
    return out


def from_text(text: Column, source_file: Column | None = None) -> Column:
    """The license that a license file's text names."""
    none = F.lit(None).cast("string")
    file = none if source_file is None else source_file
    blank = text.isNull() | ~text.rlike(r"\S")
    # the chain of markers stands once in the plan; what follows names its value
    named = F.transform(F.array(spdx_of_text(text)), lambda s: F.when(s.isNotNull(), _info(s, F.lit(TEXT_CONFIDENCE), file, none)).otherwise(unknown(F.lit(UNRECOGNIZED), file)))
    return F.when(blank, unknown()).otherwise(F.get(named, F.lit(0)))


def is_license_file(path: Column) -> Column:
    """Files at the root whose name begins like a license's."""
    return path.rlike(r"(?i)^(license|licence|copying|unlicense)[^/]*$")
