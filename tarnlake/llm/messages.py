"""What a chat message's role and content amount to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of the three speakers, compared without case, white space and enclosing marks.
SPEAKERS = {
    "user": "user human question prompter client customer ask asker query prompt input person q questioner instruction usuario utilisateur benutzer nutzer пользователь 用户 用戶 人类 提问 问 用户提问".split(),
    "assistant": "assistant model gpt ai bot answer answers chatbot chatgpt response output reply helper moss a agent llm asistente assistante assistent ассистент помощник 助手 助理 回答 答 机器人 模型".split(),
    "system": "system sys sistema système systeme систeма система systemprompt system_prompt context 系统 系統 系统提示".split(),
}

#: Stand-ins for "nothing here", compared without case and enclosing brackets.
STAND_INS = [
    "null", "none", "nil", "nan", "na", "n a", "n/a", "undefined", "empty", "blank", "no response", "no answer", "no reply", "no content", "no text", "no output", "empty response", "missing", "deleted", "removed", "tbd", "todo", "placeholder",
    "leer", "keine antwort", "kein inhalt", "vide", "pas de réponse", "aucune réponse", "vacío", "sin respuesta", "пусто", "нет ответа", "无", "空", "无内容", "无回复", "没有回答", "暂无",
]

_EDGE = r"[^\p{L}\p{N}]+"


def speaker(role: Column) -> Column:
    """user, assistant or system; null for a role that names none of them."""
    r = F.lower(F.regexp_replace(role, rf"^{_EDGE}|{_EDGE}$", ""))
    return F.when(r.isin(*SPEAKERS["user"]), "user").when(r.isin(*SPEAKERS["assistant"]), "assistant").when(r.isin(*SPEAKERS["system"]), "system")


def has_content(content: Column) -> Column:
    """False for null, blank, punctuation only, or a mere stand-in for nothing."""
    core = F.lower(F.regexp_replace(F.regexp_replace(F.left(content, F.lit(60)), rf"^{_EDGE}|{_EDGE}$", ""), r"\s+", " "))
    short = F.length(F.trim(content)) <= 40
    return F.coalesce(content.rlike(r"[\p{L}\p{N}]") & ~(short & core.isin(*STAND_INS)), F.lit(False))
