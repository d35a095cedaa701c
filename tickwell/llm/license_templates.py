"""Licence texts and notices as templates.

Markup: ``<<optional>> ... <<end>>`` may be left out, ``<<any N>>`` stands for
up to N words of any kind. All other words are mandatory. Case, punctuation
and line breaks do not count.
"""

#: Phrase and label. These must not change.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

_MIT = """
<<optional>>The MIT License<<end>> <<optional>>MIT License<<end>> <<optional>>(MIT)<<end>>
<<optional>>Copyright <<any 20>><<end>> <<optional>>All rights reserved.<<end>>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:
The above copyright notice and this permission notice <<optional>>(including the next paragraph)<<end>>
shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL <<any 12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
"""

_ISC = """
<<optional>>ISC License<<end>> <<optional>>Copyright <<any 20>><<end>>
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND <<any 8>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<any 8>> BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

_BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
<<optional>>1.<<end>> Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.
<<optional>>2.<<end>> Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.
"""
_BSD_THIRD = """
<<optional>>3.<<end>> Neither the name of <<any 12>> nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY <<any 12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""

_APACHE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at <<any 10>>
Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""

_GPL = """
<<any 4>> is free software<<optional>>:<<end>> you can redistribute it and/or modify it under the terms of
the GNU General Public License as published by the Free Software Foundation<<optional>>,<<end>>
either version {0} of the License, or (at your option) any later version.
"""

#: Label, strength of the evidence, template.
TEMPLATES = (
    ("mit", 1.0, _MIT),
    ("isc", 1.0, _ISC),
    ("bsd-2-clause", 1.0, _BSD_HEAD + _BSD_TAIL),
    ("bsd-3-clause", 1.0, _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("apache-2", 1.0, _APACHE),
    ("gpl-2", 1.0, _GPL.format(2)),
    ("gpl-3", 1.0, _GPL.format(3)),
    ("mit", 0.8, "<<optional>>Released<<end>> <<optional>>Licensed<<end>> under the MIT License"),
    ("apache-2", 0.8, "Licensed under the Apache License, Version 2.0"),
    ("gpl-2", 0.8, "under the <<optional>>terms of the<<end>> GNU General Public License <<optional>>as published by the Free Software Foundation<<end>> version 2"),
    ("gpl-3", 0.8, "under the <<optional>>terms of the<<end>> GNU General Public License <<optional>>as published by the Free Software Foundation<<end>> version 3"),
    ("lgpl-3", 0.8, "under the <<optional>>terms of the<<end>> GNU Lesser General Public License <<optional>>as published by the Free Software Foundation<<end>> version 3"),
    ("mpl-2", 0.8, "subject to the terms of the Mozilla Public License<<optional>>,<<end>> <<optional>>v. 2.0<<end>> <<optional>>Version 2.0<<end>>"),
    ("cc-by-nc", 0.8, "licensed under <<optional>>a<<end>> <<optional>>Creative Commons<<end>> CC BY-NC <<optional>>4.0<<end>>"),
    ("cc-by-sa", 0.8, "licensed under <<optional>>a<<end>> <<optional>>Creative Commons<<end>> CC BY-SA <<optional>>4.0<<end>>"),
    ("cc-by-nc", 0.8, "Creative Commons Attribution-NonCommercial <<optional>>4.0<<end>> <<optional>>International<<end>> License"),
    ("cc-by-sa", 0.8, "Creative Commons Attribution-ShareAlike <<optional>>4.0<<end>> <<optional>>International<<end>> License"),
    ("cc-by", 0.8, "Creative Commons Attribution <<optional>>4.0<<end>> <<optional>>International<<end>> License"),
    ("cc0", 0.8, "CC0 1.0 <<optional>>Universal<<end>>"),
    ("unlicense", 0.8, "This is free and unencumbered software released into the public domain"),
)
