"""Public licence texts and notices by SPDX id, and spellings that count as the same word."""

from lodestrata.llm import license_whole_texts as whole

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted"""

ISC_NOTICE = """, provided that the above copyright notice and this permission notice appear in all copies."""

ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""

BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

BSD_ENDORSEMENT = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""

BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of
the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by
a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

#: The line that closes the terms; what follows tells how to apply them, and is often left out.
END = "END OF TERMS AND CONDITIONS"
#: A line of the Apache appendix that is a copyright line, and so taken out, where its blanks are filled in.
APACHE_BLANKS = "Copyright [yyyy] [name of copyright owner]"


def terms(text: str) -> str:
    """The text up to the line that closes the terms."""
    return text[: text.index(END) + len(END)]


def plain_addresses(text: str) -> str:
    """The text as published while its addresses began with http."""
    return text.replace("https://", "http://")


#: (SPDX id, whole text). A text may stand alone, under a title, or be a one-line notice. The SQL of op10 has these.
SHORT_TEXTS = [
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("ISC", ISC_GRANT + ISC_NOTICE + "\n\n" + ISC_DISCLAIMER),
    ("ISC", "ISC License\n\n" + ISC_GRANT + ISC_NOTICE + "\n\n" + ISC_DISCLAIMER),
    ("0BSD", ISC_GRANT + ".\n\n" + ISC_DISCLAIMER),
    ("BSD-2-Clause", BSD_GRANT + "\n\n" + BSD_DISCLAIMER),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD_GRANT + "\n\n" + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_GRANT + "\n\n" + BSD_ENDORSEMENT + "\n\n" + BSD_DISCLAIMER),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + BSD_GRANT + "\n\n" + BSD_ENDORSEMENT + "\n\n" + BSD_DISCLAIMER),
    ("Zlib", ZLIB),
    ("Zlib", "zlib License\n\n" + ZLIB),
    ("BSL-1.0", BOOST),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n\n" + BOOST),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]

#: (SPDX id, whole text) of the long licences, with and without the part on how to apply them.
LONG_TEXTS = [
    ("Apache-2.0", whole.APACHE_2),
    ("Apache-2.0", whole.APACHE_2.replace(APACHE_BLANKS, "")),
    ("Apache-2.0", terms(whole.APACHE_2)),
    ("Artistic-1.0-Perl", whole.ARTISTIC),
    ("BSD-3-Clause", whole.BSD_REGENTS),
    ("CC-BY-SA-4.0", whole.CC_BY_SA_4),
    ("CC0-1.0", whole.CC0),
    ("GFDL-1.2-only", whole.GFDL_1_2),
    ("GFDL-1.3-only", whole.GFDL_1_3),
    ("GFDL-1.3-only", plain_addresses(whole.GFDL_1_3)),
    ("GPL-1.0-only", whole.GPL_1),
    ("GPL-1.0-only", terms(whole.GPL_1)),
    ("GPL-2.0-only", whole.GPL_2),
    ("GPL-2.0-only", terms(whole.GPL_2)),
    ("GPL-3.0-only", whole.GPL_3),
    ("GPL-3.0-only", plain_addresses(whole.GPL_3)),
    ("GPL-3.0-only", terms(whole.GPL_3)),
    ("LGPL-2.0-only", whole.LGPL_2),
    ("LGPL-2.0-only", terms(whole.LGPL_2)),
    ("LGPL-2.1-only", whole.LGPL_2_1),
    ("LGPL-2.1-only", terms(whole.LGPL_2_1)),
    ("LGPL-3.0-only", whole.LGPL_3),
    ("MPL-1.1", whole.MPL_1_1),
    ("MPL-2.0", whole.MPL_2),
    ("Unlicense", whole.UNLICENSE),
    ("Unlicense", whole.UNLICENSE.replace("http://", "https://")),
]

KNOWN = SHORT_TEXTS + LONG_TEXTS

#: Equivalent spellings, in canonical form (lower case, one space): the left one is read as the right one.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
]
