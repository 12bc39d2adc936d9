"""Operators that prepare text corpora for training language models; nothing outside this folder imports them."""
