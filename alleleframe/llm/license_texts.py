"""Known licence texts and the sentences that name a licence."""

from __future__ import annotations

# Public licence texts, and names of licences as they are written in notices.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

#: Whole licence texts, by SPDX identifier; titles and copyright lines are left out.
FULL_TEXTS = [
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("ISC", _ISC_GRANT + "\n\n" + _ISC_DISCLAIMER),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + "\n\n" + _ISC_DISCLAIMER),
    ("0BSD", _ISC_GRANT.split(", provided")[0] + ".\n\n" + _ISC_DISCLAIMER),
    ("BSD-2-Clause", _BSD_HEAD + "\n\n" + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + "\n\n" + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + "\n\n" + _BSD_NAME + "\n\n" + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + "\n\n" + _BSD_NAME + "\n\n" + _BSD_TAIL),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
]

#: Licence names in notices, by SPDX identifier.
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0", "GPLv3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL-2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL-3.0"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause"],
    "ISC": ["ISC License", "ISC"],
    "CC0-1.0": ["CC0 1.0", "CC0-1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
}
_OPENINGS = ["", "this work is ", "this software is ", "this project is ", "this file is "]
_VERBS = ["licensed under", "released under", "distributed under", "available under"]

#: Spellings that mean the same in a licence; the first becomes the second.
SPELLINGS = [
    ("http://", "https://"),
    ("licence", "license"),
    ("sub-licens", "sublicens"),
    ("sub licens", "sublicens"),
    ("non-infring", "noninfring"),
    ("non-commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("organis", "organiz"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("initialis", "initializ"),
    ("utilis", "utiliz"),
    ("whilst", "while"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("(c)", "copyright"),
    ("©", "copyright"),
]


def notices() -> list[tuple[str, str]]:
    """(identifier, sentence): every opening and verb with every name, with and without an article."""
    found = [
        (licence, f"{opening}{verb} {article}{name}")
        for licence, names in NAMES.items()
        for name in names
        for opening in _OPENINGS
        for verb in _VERBS
        for article in ("", "the ")
    ]
    tags = [(licence, f"SPDX-License-Identifier: {licence}") for licence in NAMES]
    return found + tags
