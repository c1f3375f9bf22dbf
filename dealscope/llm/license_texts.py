"""Licences as their licensors word them: headers, short notices and full texts."""

from __future__ import annotations

from importlib.resources import files

_GPL = ("{0} is free software{1} you can redistribute it and/or modify it under the terms of the {2} as published by the "
        "Free Software Foundation{3} {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {4} for more "
        "details.")
_PROGRAM, _LIBRARY = "This program", "This library"
_LATER = ", either version {} of the License, or (at your option) any later version."
_SOFTWARE = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
             "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND ")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
        "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."

NOTICES = {
    "AGPL-3.0-or-later-notice": _GPL.format(
        _PROGRAM, ":", "GNU Affero General Public License", _LATER.format(3), "GNU Affero General Public License"),
    "GPL-2.0-only-notice": _GPL.format(
        _PROGRAM, ";", "GNU General Public License", "; version 2 of the License.", "GNU General Public License"),
    "GPL-2.0-or-later-notice": _GPL.format(
        _PROGRAM, ";", "GNU General Public License", _LATER.format(2), "GNU General Public License"),
    "GPL-3.0-or-later-notice": _GPL.format(
        _PROGRAM, ":", "GNU General Public License", _LATER.format(3), "GNU General Public License"),
    "LGPL-2.1-or-later-notice": _GPL.format(
        _LIBRARY, ";", "GNU Lesser General Public License", _LATER.format("2.1"), "GNU Lesser General Public License"),
    "LGPL-3.0-or-later-notice": _GPL.format(
        _LIBRARY, ":", "GNU Lesser General Public License", _LATER.format(3), "GNU Lesser General Public License"),
    "CC-BY-SA-4.0": _CC.format("Attribution-ShareAlike"),
    "CC-BY-NC-4.0-notice": _CC.format("Attribution-NonCommercial"),
    "CC-BY-ND-4.0": _CC.format("Attribution-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _CC.format("Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": _CC.format("Attribution-NonCommercial-NoDerivatives"),
    "CC0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty."),
    "BSD-2-Clause-text": _BSD.format(""),
    "BSD-3-Clause-text": _BSD.format(
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. "),
    "BSL-1.0-notice": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)"),
    "EPL-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE."),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        + _SOFTWARE + "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."),
}
#: Full texts in ``licenses/``, which the driver alone reads.
FILES = {
    "Apache-2.0": "Apache-2.0", "Artistic-1.0": "Artistic", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3",
    "GPL-1.0": "GPL-1", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.0": "LGPL-2", "LGPL-2.1": "LGPL-2.1",
    "LGPL-3.0": "LGPL-3", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}


def full_texts() -> dict[str, str]:
    folder = files("dealscope.llm") / "licenses"
    return {f"{name}-text": (folder / f"{file}.txt").read_text("utf-8") for name, file in FILES.items()}
