"""License texts for ``license_scan``: (license, family, text). Texts of one family differ in little but their version.

Short licenses stand as whole texts, without title and copyright line; long ones as whole texts (``license_texts``), by their
standard headers and by notices.
"""

from __future__ import annotations

from pathlib import Path

_AS_IS = """this software is provided by the copyright holders and contributors "as is" and any express or implied warranties,
including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. in no
event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential
damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business
interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or
otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission. """
_GNU = """This {it} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the
Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {it} is distributed in the hope
that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the GNU {kind} for more details."""
_KINDS = (
    ("GPL-2.0", "GNU", "General Public License", "2", "program"), ("GPL-3.0", "GNU", "General Public License", "3", "program"),
    ("LGPL-2.1", "GNU", "Lesser General Public License", "2.1", "library"), ("LGPL-3.0", "GNU", "Lesser General Public License", "3", "library"),
    ("AGPL-3.0", "GNU", "Affero General Public License", "3", "program"))
_CC = (("CC-BY", "Attribution"), ("CC-BY-SA", "Attribution-ShareAlike"), ("CC-BY-NC", "Attribution-NonCommercial"),
       ("CC-BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("CC-BY-ND", "Attribution-NoDerivatives"),
       ("CC-BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))

_WHOLE = (("Apache-2.0", "Apache"), ("CC0-1.0", "CC"), ("GPL-2.0", "GNU"), ("GPL-3.0", "GNU"), ("LGPL-2.1", "GNU"), ("LGPL-3.0", "GNU"),
          ("MPL-2.0", "MPL"))

LICENSES = (
    *((name, family, (Path(__file__).parent / "license_texts" / f"{name}.txt").read_text("utf-8")) for name, family in _WHOLE),
    ("MIT", "MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSD-2-Clause", "BSD", _BSD + _AS_IS),
    ("BSD-3-Clause", "BSD", _BSD + _BSD3 + _AS_IS),
    ("ISC", "ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""),
    ("Zlib", "Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software
must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment
in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must
not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("Unlicense", "Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""),
    ("Apache-2.0", "Apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("MPL-2.0", "MPL", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    *((name, family, _GNU.format(it=it, colon=colon, kind=kind, version=v)) for name, family, kind, v, it in _KINDS for colon in ("; ", ": ")),
    *((name, family, f"licensed under the GNU {kind}, version {v}") for name, family, kind, v, _ in _KINDS),
    *((name, family, f"licensed under the GNU {kind} v{v}") for name, family, kind, v, _ in _KINDS),
    *((f"{name}-{v}", "CC", f"licensed under a Creative Commons {words} {v} {where} License") for name, words in _CC
      for v, where in (("3.0", "Unported"), ("4.0", "International"))),
    *((f"{name}-{v}", "CC", f"licensed under CC {name[3:]} {v}") for name, _ in _CC for v in ("3.0", "4.0")),
    ("Apache-2.0", "Apache", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "MIT", "Released under the MIT License"),
    ("MIT", "MIT", "Licensed under the MIT License"),
    ("BSD-3-Clause", "BSD", "licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "BSD", "licensed under the BSD 2-Clause License"),
    ("MPL-2.0", "MPL", "licensed under the Mozilla Public License, version 2.0"),
)
