"""Word lists."""

from __future__ import annotations

# The customary English stop words of the study's cleaning step.
# Tokens are letters only, so contractions appear as their pieces ("don", "t").
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which
who whom this that these those am is are was were be been being have has had having do
does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will
just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma
mightn mustn needn shan shouldn wasn weren won wouldn
""".split()

# Topic name -> case-sensitive substrings that mark a text.
TOPIC_TERMS = {
    "police": ["police", "law", "enforcement", "brutality", "order"],
    "healthcare": ["health", "insur", "pharma", "diagnos", "medicine", "vaccin"],
    "climate": ["climate", "energy", "renewable", "deforest", "global warming"],
    "economy": ["tax", "inflation", "economy", "costs", "unemployment"],
    "education": ["school", "education", "learn", "class", "teacher"],
    "trump": ["trump", "Trump"],
}

# Texts that stand for something removed.
REMOVED_BODIES = ["[removed]", "[deleted]"]
REMOVED_TITLES = ["[deleted by user]"]

# Sentiment classes.
SENTIMENTS = ["negative", "neutral", "positive"]
