"""The wordings by which texts state common licenses.

Short licenses are given in full. Of long ones there are the opening passages, which every copy
of the full text holds, and the notices that they ask for; thirteen of them lie as whole texts,
word for word, in the folder `whole_licenses`, one file a license. One-line notices are made of
a license's usual names.
"""

from __future__ import annotations

from importlib.resources import files

_LEADS = ("under", "under the", "under a", "licensed", "the terms of", "the terms of the")

_NAMES = {
    "MIT": ("MIT License", "MIT Licence", "MIT/X11 License", "MIT open source License", "Expat License"),
    "Apache-2.0": (
        "Apache License 2.0", "Apache License, Version 2.0", "Apache License v2.0", "Apache License v2",
        "Apache Software License 2.0", "Apache Software License, Version 2.0", "Apache 2.0", "Apache-2.0",
        "Apache 2", "Apache License 2",
    ),
    "MPL-2.0": (
        "Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0",
        "Mozilla Public License v2.0", "MPL 2.0", "MPL-2.0", "MPL version 2.0",
    ),
    "BSD-3-Clause": (
        "BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause", "New BSD License", "Modified BSD License",
        "Revised BSD License",
    ),
    "BSD-2-Clause": (
        "BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause", "Simplified BSD License", "FreeBSD License",
    ),
    "ISC": ("ISC License", "ISC Licence"),
    "0BSD": ("Zero-Clause BSD License", "BSD Zero Clause License", "0BSD"),
    "Zlib": ("zlib License", "zlib/libpng License"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License, Version 1.0", "BSL-1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, Version 2.0", "Eclipse Public License v2.0", "Eclipse Public License - v 2.0", "EPL-2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0-1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0"),
}


def _gnu(long: str, short: str, version: str) -> tuple[str, ...]:
    versions = dict.fromkeys((version, version.removesuffix(".0")))
    return (
        f"{short}-{version}-only", f"{short}-{version}-or-later",
        *[f"{name}{way}{v}" for v in versions for name in (f"GNU {long}", f"GNU {short}", short) for way in (" version ", " v", " ")],
        *[f"{name}v{v}" for v in versions for name in (f"GNU {short}", short)],
    )


for _long, _short, _versions in (
    ("General Public License", "GPL", ("2.0", "3.0")),
    ("Lesser General Public License", "LGPL", ("2.1", "3.0")),
    ("Affero General Public License", "AGPL", ("3.0",)),
):
    _NAMES |= {f"{_short}-{v}": _gnu(_long, _short, v) for v in _versions}

for _short, _long in {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}.items():
    for _v in ("2.0", "2.5", "3.0", "4.0"):
        _NAMES[f"CC-{_short}-{_v}"] = (
            f"CC {_short} {_v}", f"CC-{_short} {_v}", f"CC-{_short}-{_v}", f"Creative Commons {_short} {_v}",
            *[f"Creative Commons {_long}{way} {_v}" for way in ("", " License", " International", " Unported")],
        )

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met"
)
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THREE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)


def _gnu_notice(thing: str, name: str, version: str) -> str:
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        "later version."
    )


_PASSAGES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        f"Software. {_AS_IS}",
    ),
    "Apache-2.0": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION 1. Definitions. License shall mean the terms and conditions for use, "
        "reproduction, and distribution as defined by Sections 1 through 9 of this document.",
    ),
    "GPL-3.0": (
        _gnu_notice("program", "General Public License", "3"),
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is "
        "permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ),
    "GPL-2.0": (
        _gnu_notice("program", "General Public License", "2"),
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License version 2 as published by the Free Software Foundation.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. Everyone "
        "is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ),
    "LGPL-3.0": (
        _gnu_notice("program", "Lesser General Public License", "3"),
        _gnu_notice("library", "Lesser General Public License", "3"),
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. "
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ),
    "LGPL-2.1": (
        _gnu_notice("library", "Lesser General Public License", "2.1"),
        _gnu_notice("program", "Lesser General Public License", "2.1"),
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, "
        "Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ),
    "AGPL-3.0": (
        _gnu_notice("program", "Affero General Public License", "3"),
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. "
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that "
        "creates, contributes to the creation of, or owns Covered Software.",
    ),
    "BSD-3-Clause": (_BSD_HEAD, f"{_BSD_HEAD}: {_BSD_TWO} {_BSD_THREE} {_BSD_END}"),
    "BSD-2-Clause": (f"{_BSD_HEAD}: {_BSD_TWO}", f"{_BSD_HEAD}: {_BSD_TWO} {_BSD_END}"),
    "ISC": (
        f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.",
        f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}",
    ),
    "0BSD": (f"{_ISC}.", f"{_ISC}. {_ISC_END}"),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for "
        "any purpose, commercial or non-commercial, and by any means.",),
    "Zlib": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions",),
    "BSL-1.0": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and "
        "transmit the Software",),
}

_LINES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "MIT License Copyright"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "version 3 of the GNU General Public License"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "version 2 of the GNU General Public License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "EPL-2.0": ("Eclipse Public License - v 2.0",),
}

TEMPLATES: dict[str, tuple[str, ...]] = {
    name: (
        *_LINES.get(name, ()),
        *_PASSAGES.get(name, ()),
        f"SPDX-License-Identifier: {name}",
        *[f"{lead} {own}" for own in _NAMES.get(name, ()) for lead in _LEADS],
    )
    for name in dict.fromkeys([*_LINES, *_PASSAGES, *_NAMES])
}


def whole_texts() -> dict[str, str]:
    """The whole texts of long licenses, by name."""
    folder = files(__package__).joinpath("whole_licenses")
    found = sorted(folder.iterdir(), key=lambda file: file.name)
    return {file.name.removesuffix(".txt"): file.read_text("utf-8") for file in found}
