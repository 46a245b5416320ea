"""Plain-Python corpus BLEU written from the papers, used only to cross-check the Spark plan."""

import math
import re
from collections import Counter

MAX_ORDER = 4


def corpus_bleu_local(hyps: list[str], refs: list[str]) -> float:
    """Tiny pure-Python scorer used only by tests to cross-check the Spark plan on fixtures."""
    def tok(s: str) -> list[str]:
        s = s.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
        s = s.replace("&quot;", '"').replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
        out = ""
        s = f" {s} "
        for i, c in enumerate(s):
            before, after = s[i - 1:i], s[i + 1:i + 2]
            if c in ".,":
                # a dot or comma stands alone unless digits are on both sides
                alone = not (before.isdecimal() and after.isdecimal() and before.isascii() and after.isascii())
            elif c == "-":
                alone = before.isdecimal() and before.isascii()
            else:
                alone = c.isascii() and c.isprintable() and not c.isalnum() and c not in " '"
            out += f" {c} " if alone else c
        return out.split()

    match = [0] * MAX_ORDER
    total = [0] * MAX_ORDER
    sys_len = ref_len = 0
    for h, r in zip(hyps, refs):
        th, tr = tok(h), tok(r)
        sys_len += len(th)
        ref_len += len(tr)
        for n in range(1, MAX_ORDER + 1):
            ch = Counter(tuple(th[i:i + n]) for i in range(len(th) - n + 1))
            cr = Counter(tuple(tr[i:i + n]) for i in range(len(tr) - n + 1))
            match[n - 1] += sum(min(v, cr[g]) for g, v in ch.items())
            total[n - 1] += sum(ch.values())
    if not any(match):
        return 0.0
    smooth, logs = 1.0, []
    alive = True
    for n in range(MAX_ORDER):
        alive = alive and total[n] > 0
        if not alive:
            logs.append(-9999999999.0)
            continue
        if match[n] == 0:
            smooth *= 2
            p = 100.0 / (smooth * total[n])
        else:
            p = 100.0 * match[n] / total[n]
        logs.append(math.log(p))
    bp = 1.0 if sys_len >= ref_len else (math.exp(1 - ref_len / sys_len) if sys_len else 0.0)
    return bp * math.exp(sum(logs) / MAX_ORDER)
