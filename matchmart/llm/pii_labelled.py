"""Hand-labelled texts for the field of operator 3: ``[kind:...]`` marks a span.

They hold the plain forms, the forms that the base rules merge or refuse (cards
side by side, a phone before an ip or a number, other marks between digits) and
numbers that are no personal data.
"""

from __future__ import annotations

import re

TEXTS = """
Write to [email:anna.berg@mail.example.com] before noon
the list is kept by [email:j_ross77@lists.example.org], who answers within 2 days
Kontakt: [email:info@haus-7.example.de] oder [phone:+49 30 555 0199]
[email:a1@b2.example.com] [email:c3@d4.example.com]
escribe a [email:luz.m+news@correo.example.es] [phone:+34 (915) 555-0142]
mail [email:pierre @ exemple.fr] for the 12 forms
her address is [email:k.lee@localhost] on the old machine
server [ip:10.0.0.12] answered in 35 ms
from [ip:192.168.1.254] to [ip:172.16.31.7] at 14:05
the hosts [ip:203.0.113.9] [ip:198.51.100.23] were down for 3 hours
login from [ip:198.18.40.61] was refused
card [card:4111111111111111] was used in 2019
paid with [card:5555555555554444] on 3 May
[card:4012888888881881] [card:5105105105105100]
the cards [card:6011111111111117] [card:4242424242424242] were lost
both [card:5200828282828210] [card:6011000990139424] on file
karten [card:3530111333300000] [card:3566002020360505] [card:4000056655665556] gesperrt
word [card:2223003122003222] [card:4111111111111111] word
in [card:4242424242424242] [card:5555555555554444] de la
[card:4000056655665556] [phone:+1 (212) 555-0143] of the
[phone:+1 (646) 555-0187] [card:6011111111111117] und
carte [card:4111 1111 1111 1111] valable
number [card:5555-5555-5555-4444] expires 12/27
amounts 120 [card:4012888888881881] 45
his card is [card:4111.1111.1111.1111] they said
charge [card:5105/1051/0510/5100] today
call [phone:+1 (908) 555-0154] now
phone [phone:+1 (305) 555-0110] [ip:198.18.40.61] the end
the [phone:+1 (404) 555-0175] [ip:10.20.30.40] on
und [phone:+1 (917) 555-2290] [ip:203.0.113.77] der
el [phone:+1 (713) 555-8812] [ip:8.8.4.4] la
le [phone:+1 (512) 555-6634] [ip:172.31.255.1] est
[phone:+1 (206) 555-0131] [ip:198.51.100.200]
[ip:192.0.2.146] [phone:+1 (415) 555-0166] word
[phone:+1 (503) 555-9071] [phone:+1 (602) 555-3348] of
the [phone:+1 (303) 555-4520] [phone:+1 (801) 555-7719] [ip:100.64.3.9] in
[email:t.ito@post.example.jp] [phone:+1 (619) 555-2093] [ip:203.0.113.5]
ring [phone:+44 20 7946 0958] after six
numero [phone:+33 1 99 00 12 34] ou [email:x@y.example.fr]
reach us at [phone:(212) 555-0143] today
office [phone:(646) 555-0187], room 12
the desk [phone:(305) 555-0110] is open from 9 to 5
on call: [phone:212-555-0147] or [phone:415-555-0199]
dial [phone:303-555-0121] for help
Version 2.10.3 was released in 2021
see section 3.1.4 and table 12 on page 481
the price rose from 1200 to 1450 in 2008
about 1,250,000 people in 37 towns
born 1984-05-17 and moved in 1999
2024-01-31 12:45:10 started, 2024-01-31 12:59:02 ended
order 123456789 of 2020 has 14 items
ticket 20230517001 and ticket 20230517002 are closed
id 1234567890123456 is not valid
the numbers 1000000000000001 1000000000000002 are row ids
serial 9876543210987654321 and part 77341
1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16
12 34 56 78 90 12 34 56
score 3-2, 1-0 and 4-4 in 1997-98
build 300.400.500.600 is wrong, 999.1.1.1 too
isbn 978-3-16-148410-0 second edition
a@ b and @home at 5 @ 20
+ 5 and +10 or +3.5 percent
pi is 3.14159265358979 or so
(12) (345) and (6)
sum 555 and 0143 of 212
x = 4111 + 1111
the 45 and 2010 of 7 in 300
w12 x7 abc99 2b 3c
room 101 - 102, rows 10-20, pages 100-110
hash 5f3a9c77d1 and 00ff12ab34cd
copy of 2016 all rights reserved 2016-2020
""".strip().splitlines()

_MARK = re.compile(r"\[(email|ip|card|phone):([^\]]*)\]")


def rows() -> list[tuple[str, str]]:
    """(text, spans as ``kind:start:end``, comma-joined) of every text."""
    out = []
    for line in TEXTS:
        text, spans, at = "", [], 0
        for m in _MARK.finditer(line):
            text += line[at:m.start()]
            spans.append(f"{m[1]}:{len(text)}:{len(text) + len(m[2])}")
            text += m[2]
            at = m.end()
        out.append((text + line[at:], ",".join(spans)))
    return out
