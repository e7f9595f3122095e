"""Words by regular expression: runs of letters, digits and marks; characters of scripts without spaces each alone."""

import regex

ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af"
WORD = regex.compile(rf"(?V1)[[\p{{L}}\p{{N}}\p{{M}}]&&[{ALONE}]]|[[\p{{L}}\p{{N}}\p{{M}}]--[{ALONE}]]+")
