"""Texts that results must contain as they are."""

INTERCEPTED = "拦截消息:"
INTERCEPTED_FOR = ", 原因:包含拦截关键字："
LENGTH_IS = " :合计 "
CHARACTERS = "个字"
OVER_LIMIT = "超过阈值:"
