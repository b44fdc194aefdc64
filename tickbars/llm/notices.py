"""Texts that windows of terms are compared with: titles, notices for file headers, tags, and whole licences.

The whole licences are files in ``licences``; AGPL-3.0 and the Creative Commons ones
but CC0-1.0 are known by title, notice and tag only.  The driver alone reads them.
"""

from __future__ import annotations

from pathlib import Path

_FREE = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General Public "
    "License as published by the Free Software Foundation, {version} {rest}"
)
_LATER = "either version {} of the License, or (at your option) any later version."
_WARRANTY = (
    " This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}General Public License for more details."
)


def _gnu(licence: str, name: str, what: str, version: str) -> list[tuple[str, str]]:
    later = _FREE.format(what=what, name=name, version=_LATER.format(version), rest="")
    only = _FREE.format(what=what, name=name, version=f"version {version}", rest="of the License.")
    return [(licence, later), (licence, only), (licence, later + _WARRANTY.format(what=what, name=name))]


NOTICES = [
    *_gnu("AGPL-3.0", "Affero ", "program", "3"),
    *_gnu("GPL-2.0", "", "program", "2"),
    *_gnu("GPL-3.0", "", "program", "3"),
    *_gnu("LGPL-2.1", "Lesser ", "library", "2.1"),
    *_gnu("LGPL-3.0", "Lesser ", "library", "3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
     "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
     "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
     "limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3"),
    ("MIT", "MIT License"),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]

_GNU_TAGS = ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")
_TAGS = [
    "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "MIT", "MPL-2.0", "Unlicense",
    *(tag + end for tag in _GNU_TAGS for end in ("", "+", "-only", "-or-later")),
]
NOTICES += [(next((g for g in _GNU_TAGS if t.startswith(g)), t), f"SPDX-License-Identifier: {t}") for t in _TAGS]


def texts() -> list[tuple[str, str]]:
    """Name and text of each whole licence."""
    folder = Path(__file__).parent / "licences"
    return [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(folder.glob("*.txt"))]
