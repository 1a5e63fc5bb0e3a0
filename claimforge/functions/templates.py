"""Query templates, made by a rule: each family joins openings with endings, up to its number of templates."""

from __future__ import annotations

from itertools import islice, product

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rand

#: family: (id prefix, number of templates, openings, endings). "{event}" is filled in when a query is drawn.
FAMILIES = {
    "OBJECT_SINGLE": ("obj_s", 20, ("Which object", "What single object", "Which one of these objects", "Which item"), ("can be seen in the video?", "appears in the clip?", "does the video show?", "is visible at some point?", "shows up in the scene?")),
    "OBJECT_SET": ("obj_m", 20, ("Which objects", "Which of these objects", "Select all objects that", "Mark every object that"), ("can be seen in the video.", "appear in the clip.", "turn up in the footage.", "are visible at some point.", "belong to the scene.")),
    "OBJECT_VERIFY": ("obj_v", 20, ("Which statement", "Which claim", "Which sentence", "Which description"), ("about the object is true?", "on the object's presence holds?", "on what is present is right?", "about the scene's objects fits?", "matches the objects shown?")),
    "ACTION": ("act_s", 25, ("Which action", "What action", "Which activity", "What activity", "Which of these actions"), ("does the person perform?", "takes place in the video?", "can be observed?", "is carried out?", "does the clip show?")),
    "ACTION_VERIFY": ("act_v", 20, ("Which statement", "Which claim", "Which sentence", "Which description"), ("about the action is true?", "about what the person does holds?", "on the activity is right?", "fits the person's behaviour?", "matches the movement shown?")),
    "RELATION": ("rel_s", 25, ("Which statement", "Which relation", "Which description", "Which claim", "Which of these"), ("tells how the person relates to the object?", "holds between person and object?", "describes the interaction?", "fits the person and the object?", "is shown by the video?")),
    "RELATION_VERIFY": ("rel_v", 20, ("Which statement", "Which claim", "Which sentence", "Which description"), ("about the relation is true?", "on the interaction holds?", "about person and object is right?", "fits the contact shown?", "matches the positions shown?")),
    "TEMPORAL": ("temp_v", 30, ("Which statement", "Which claim", "Which sentence", "Which order", "Which account"), ("about the order of events is true?", "tells the sequence rightly?", "fits the timeline?", "matches what comes first?", "holds for the course of events?", "puts the events in order?")),
    "TEMPORAL_BEFORE": ("temp_b", 15, ("What happens before", "Which event comes before", "What does the person do before"), ("{event}?", "the moment of {event}?", "the person is {event}?", "they start {event}?", "the part with {event}?")),
    "TEMPORAL_AFTER": ("temp_a", 15, ("What happens after", "Which event follows", "What does the person do after"), ("{event}?", "the moment of {event}?", "the person is {event}?", "they finish {event}?", "the part with {event}?")),
    "TEMPORAL_DURING": ("temp_d", 10, ("What happens during", "Which event goes along with"), ("{event}?", "the moment of {event}?", "the person's {event}?", "the time of {event}?", "the part with {event}?")),
    "GROUNDING_SINGLE": ("grnd_s", 20, ("Which object", "What object", "Which item", "What thing"), ("is in the marked box?", "does the region show?", "fills the bounding box?", "is found at this location?", "lies inside the frame's box?")),
    "GROUNDING_VERIFY": ("grnd_v", 20, ("Which statement", "Which claim", "Which sentence", "Which description"), ("about the box is true?", "about the region holds?", "on this location is right?", "fits the marked area?", "matches the bounding box?")),
    "GROUNDING_SET": ("grnd_m", 10, ("Which objects", "Which of these objects"), ("are in this frame?", "does the frame show?", "can be seen here?", "belong to this moment?", "are visible in it?")),
    "COMPOSITIONAL": ("comp_s", 20, ("Which joint statement", "Which combination", "Which pair of relations", "Which double claim"), ("holds for the object?", "is true of the person?", "fits the interaction?", "does the video show?", "matches both relations?")),
    "COMPOSITIONAL_VERIFY": ("comp_v", 15, ("Which statement", "Which claim", "Which sentence"), ("about both relations is true?", "on the joint interaction holds?", "on the pair of relations is right?", "fits both parts?", "matches the whole?")),
    "UNCERTAINTY": ("unc", 10, ("What can be said", "What is known"), ("about this?", "from the video alone?", "with certainty?", "on the evidence given?", "at this point?")),
}
TEMPLATES = {name: [(f"{prefix}{i:02}", f"{a} {b}") for i, (a, b) in enumerate(islice(product(openings, endings), n), 1)] for name, (prefix, n, openings, endings) in FAMILIES.items()}


def query(family: str, *parts: Column | str | int, event: Column | None = None) -> Column:
    """A drawn template as struct (template_id, text); an unknown family falls back on OBJECT_SET."""
    rows = TEMPLATES.get(family, TEMPLATES["OBJECT_SET"])
    number = rand.integer(0, len(rows) - 1, *parts)
    text = F.get(rand.strings(t for _, t in rows), number)
    text = text if event is None else F.replace(text, F.lit("{event}"), event)
    return F.struct(F.get(rand.strings(i for i, _ in rows), number).alias("template_id"), text.alias("text"))
