"""Statements in English, as column expressions. Where a rule reads a fixed phrase, the phrase is data of the domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import UNCOUNTABLE


def article(noun: Column) -> Column:
    """"", "a" or "an"."""
    bare = noun.isNull() | (noun == "") | F.lower(noun).isin(*UNCOUNTABLE)
    return F.when(bare, "").when(F.lower(F.substring(noun, 1, 1)).isin(*"aeiou"), "an").otherwise("a")


def noun_phrase(noun: Column, definite: bool = False) -> Column:
    with_article = F.concat(F.lit("the "), noun) if definite else F.ltrim(F.concat(article(noun), F.lit(" "), noun))
    return F.when(noun.isNull() | (noun == ""), "something").otherwise(with_article)


def sentence_case(text: Column) -> Column:
    """First letter upper, all others lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 20)))


def existence(noun: Column, negative: bool = False) -> Column:
    verb = F.when(F.lower(noun) == "clothes", " are").otherwise(" is")
    return F.concat(sentence_case(noun_phrase(noun)), verb, F.lit(" not present." if negative else " present."))


def relation_phrase(name: Column) -> Column:
    """A relation's name as it reads after "is"."""
    return F.replace(F.replace(name, F.lit("have it on the back"), F.lit("carrying on their back")), F.lit("other relationship"), F.lit("interacting with"))


def relation(name: Column, noun: Column, negative: bool = False) -> Column:
    verb = relation_phrase(name)
    if negative:
        verb = F.when(verb.startswith("not "), F.substring(verb, 5, 1 << 20)).otherwise(F.concat(F.lit("not "), verb))
    return F.concat(F.lit("The person is "), verb, F.lit(" "), noun_phrase(noun, definite=True), F.lit("."))


def action(phrase: Column, negative: bool = False) -> Column:
    said = F.concat(F.lit("The person is not " if negative else "The person is "), phrase, F.lit("."))
    return F.when(phrase.isNull() | (phrase == ""), "The person is doing something.").otherwise(said)


def bare_event(event: Column) -> Column:
    """An event without "The person (is)" before it and a full stop behind it."""
    bare = F.regexp_replace(F.regexp_replace(event, r"^The person (is )?", ""), r"\.$", "")
    return F.when(event.startswith("The person ") | event.contains("."), bare).otherwise(event)


def temporal(a: Column, b: Column, relation_word: Column | str = "before", negative: bool = False) -> Column:
    word = relation_word if isinstance(relation_word, Column) else F.lit(relation_word)
    return F.concat(F.lit("The person is not " if negative else "The person is "), bare_event(a), F.lit(" "), word, F.lit(" "), bare_event(b), F.lit("."))


def grounding(noun: Column, negative: bool = False) -> Column:
    return F.concat(F.lit("This region does not contain " if negative else "This region contains "), noun_phrase(noun, definite=True), F.lit("."))
