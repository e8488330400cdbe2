"""Word lists, patterns, weights and limits that results depend on."""

# Words that leave a clause open at the end of a text.
OPEN_CLAUSE_WORDS = [
    "of", "to", "for", "with", "in", "on", "at", "by", "from", "into", "through", "during", "before", "after", "above", "below", "between",
    "under", "over", "about", "against", "among", "around", "without", "and", "or", "but", "nor", "so", "yet", "both", "either", "neither",
    "the", "a", "an", "that", "which", "who", "whom", "whose", "where", "when", "while", "is", "are", "was", "were", "be", "been", "being",
    "as", "if", "whether", "although", "because", "since", "unless", "such", "than", "these", "those", "this", "its",
    "real", "financial", "more", "most", "less", "least", "other", "another",
]
# Words that carry on from what came before.
CONTINUATION_STARTERS = [
    "and", "or", "but", "nor", "so", "yet", "also", "however", "therefore", "thus", "hence", "moreover", "furthermore", "which", "that", "who",
    "where", "when", "while", "because", "since", "although", "though", "unless", "as", "if", "whether", "whereas",
]
COMPOUND_PREFIXES = ["self", "non", "pre", "post", "anti", "semi", "multi", "co", "re"]
IMPERATIVE_VERBS = [
    "calculate", "compute", "determine", "find", "solve", "evaluate", "identify", "analyze", "compare", "explain", "describe", "define",
    "list", "state", "prove", "show", "demonstrate", "derive", "verify", "apply", "use", "consider", "note", "observe", "recall", "remember",
]
IMPERATIVE_VERBS_EMBEDDING = ["calculate", "compute", "determine", "find", "solve", "evaluate", "identify", "analyze"]
OBJECTIVE_VERBS = [
    "list", "describe", "state", "identify", "name", "label", "recall", "select", "match", "explain", "clarify", "discuss", "report", "review",
    "summarize", "illustrate", "apply", "implement", "solve", "use", "compute", "calculate", "estimate", "demonstrate", "analyze",
    "differentiate", "distinguish", "compare", "contrast", "examine", "evaluate", "assess", "judge", "appraise", "defend", "justify", "critique",
    "create", "design", "formulate", "compose", "construct", "develop", "derive", "specify", "understand", "outline", "point",
]
OBJECTIVE_PATTERNS = [r"\blearning\s+objectives?\b", r"\bat\s+the\s+end\s+of\b", r"\byou\s+will\s+be\s+able\s+to\b", r"\bafter\s+studying\b"]
CAPTION_VERBS = [
    "shows", "presents", "displays", "illustrates", "depicts", "demonstrates", "provides", "contains", "compares", "summarizes", "lists", "is a",
    "is the", "is an", "was", "were", "has", "have", "gives", "indicates", "reveals", "suggests", "confirms", "adjusts", "rearranged", "expresses",
    "calculates", "defines",
]

CAPTION_PATTERNS = [
    r"^(?:Table|Tbl\.?)\s*(\d+(?:\.\d+)?)", r"^(?:Figure|Fig\.?)\s*(\d+(?:\.\d+)?(?:\s*\([a-z]\))?)", r"^(?:Exhibit)\s*(\d+(?:\.\d+)?)",
    r"^(?:Equation|Eq\.?)\s*\(?\s*(\d+(?:\.\d+)?)\s*\)?", r"^(?:Formula)\s*\(?\s*(\d+(?:\.\d+)?)\s*\)?", r"^(?:Chart|Graph|Diagram)\s*(\d+(?:\.\d+)?)",
]
CATALOG_PATTERNS = [
    ("Figure", r"^(?:Figure|Fig\.?)\s*(\d+(?:\.\d+)?)"), ("Table", r"^(?:Table|Tbl\.?)\s*(\d+(?:\.\d+)?)"),
    ("Picture", r"^(?:Figure|Fig\.?)\s*(\d+(?:\.\d+)?)"), ("Formula", r"^(?:Equation|Eq\.?)\s*\((\d+)\)"), ("Equation", r"^(?:Equation|Eq\.?)\s*\((\d+)\)"),
]

# Older caption rules: verbs right after the number that make a sentence of it; prefixes without an id.
CAPTION_VERBS_LEGACY = [
    "shows", "presents", "displays", "illustrates", "depicts", "demonstrates", "provides", "contains", "compares", "summarizes", "lists", "is a",
    "is the", "plots", "graphs", "charts", "traces", "reports", "is an", "was", "were", "has", "have", "gives", "indicates", "reveals", "suggests",
    "confirms",
]
CAPTION_PREFIXES = [r"^(?:Table|Figure|Exhibit|Chart|Graph|Equation|Formula|Exh\.|Fig\.)\s+[\d.]+[A-Za-z]?[:.]?\s+", r"^(?:Table|Figure|Exhibit|Chart|Graph|Equation|Formula|Exh\.|Fig\.)\s+\d+\s+[:.]?\s+"]
# Labels of named entities that save a short sentence.
ENTITY_LABELS = ["PERSON", "ORG", "GPE", "LOC", "PRODUCT", "EVENT", "WORK_OF_ART", "LAW"]
# Headings whose path makes a sidebar.
SIDEBAR_PATHS = ["OBJECTIVES", "KEY TERMS", "KEY POINTS", "TAKEAWAY", "SUMMARY", "HIGHLIGHTS"]

# Discourse tags in their order, each with its patterns.
TAGS = {
    "definition": [r"\bis\s+defined\s+as\b", r"\brefers\s+to\b", r"\bis\s+a\s+(?:type|form|kind)\s+of\b", r"\bcan\s+be\s+defined\b", r"\bmeans\s+that\b", r"\bwe\s+define\b", r"\blet\s+\w+\s+be\b", r":\s*(?:a|an|the)\s+\w+\s+(?:that|which)"],
    "theorem": [r"^(?:Theorem|Lemma|Proposition|Corollary)\s*\d*", r"\btheorem\s+\d+", r"\blemma\s+\d+", r"\bproposition\s+\d+", r"\bcorollary\s+\d+"],
    "proof": [r"^Proof[:\.]", r"\bproof\s+of\b", r"\bQ\.E\.D\.", r"∎", r"\bwe\s+(?:prove|show)\s+that\b"],
    "rule": [r"\bmust\s+(?:be|have|always)\b", r"\brequired\s+to\b", r"\bprinciple\s+(?:of|that)\b", r"\balways\s+(?:results|leads)\b", r"\bnever\s+(?:should|can)\b", r"\blaw\s+of\b", r"\bproperty\s+(?:of|that)\b"],
    "application": [r"\bin\s+practice\b", r"\bapplied\s+to\b", r"\bused\s+(?:to|for|in)\b", r"\bpractical\s+(?:use|application)\b", r"\breal-world\b"],
    "example": [r"\bfor\s+example\b", r"\bfor\s+instance\b", r"\bsuch\s+as\b", r"\bconsider\s+(?:the|a)\b", r"\bsuppose\s+(?:that|we)\b", r"\billustrat(?:e|ed|ion)\b", r"^Example\s*\d*", r"\bcase\s+study\b"],
    "reference": [r"\b(?:figure|fig\.?|table|tbl\.?|exhibit|chart|appendix|box|equation|eq\.?)\s+\d+", r"\bsee\s+(?:figure|fig\.?|table|tbl\.?|eq\.?)\b", r"\bas\s+shown\s+in\b", r"\billustrated\s+in\b", r"\b(?:referenced|discussed|presented)\s+in\b", r"\[(?:Table|Figure|Eq\.?)\s+\d+\]", r"\((?:see|refer\s+to)?\s*(?:Figure|Fig\.?|Table|Tbl\.?|Equation|Eq\.?)\s+\d+\)", r"^(?:Table|Figure|Fig\.?|Equation|Eq\.?)\s+\d+"],
    "procedure": [r"\bstep\s+\d+\b", r"^\s*\d+\.\s+[A-Z]", r"\bprocedure\b", r"\bprocess\s+(?:of|for)\b", r"\balgorithm\b", r"\bmethod\s+(?:for|to)\b", r"^(?:First|Second|Third|Finally|Next|Then),?\s"],
    "key_term": [r"\bkey\s+(?:term|concept|point|idea)\b", r"\bimportant(?:ly)?\b", r"\bessential(?:ly)?\b", r"\bfundamental\b", r"\bcritical(?:ly)?\b", r"\bsignificant(?:ly)?\b"],
    "summary": [r"\bin\s+summary\b", r"\bto\s+summarize\b", r"\bin\s+conclusion\b", r"\boverall\b", r"\bto\s+recap\b", r"^Summary\b"],
    "introduction": [r"^Introduction\b", r"\bthis\s+(?:chapter|section)\s+(?:introduces|presents|discusses)\b", r"\boverview\s+of\b", r"\bin\s+this\s+(?:chapter|section)\b"],
    "comparison": [r"\bcompare(?:d)?\s+(?:to|with)\b", r"\bversus\b", r"\bunlike\b", r"\bsimilar\s+to\b", r"\bdifferent\s+from\b", r"\bin\s+contrast\b", r"\bon\s+the\s+other\s+hand\b"],
    "caution": [r"\bcaution\b", r"\bwarning\b", r"\bbe\s+careful\b", r"\bavoid\b", r"\bdo\s+not\b", r"\bnote\s+that\b", r"\bimportant:\b"],
    "assumption": [r"^\s*(?:Suppose|Assume|Imagine)\b", r"\bassume\s+(?:that|we)\b", r"\bassuming\b", r"\bgiven\s+that\b", r"\bsuppose\s+(?!to\b)(?:that|we|\w+)\b", r"\bunder\s+the\s+assumption\b"],
    "evidence": [r"\b\d+(?:\.\d+)?\s*(?:%|percent)\b", r"\b(?:p\s*[<>=]\s*[\d.]+|significant(?:ly)?)\b", r"\b(?:correlation|r\s*=|R²\s*=)\b", r"\b(?:increase[ds]?|decrease[ds]?|grew|rose|fell|declined)\s+(?:by|to)\s+[\d.]+", r"\$[\d,]+(?:\.\d+)?(?:\s*(?:million|billion|trillion))?", r"\b\d+\s*(?:bps|basis\s+points?|bp)\b", r"\b(?:mean|median|average|std|standard\s+deviation)\s*[=:\s]*[\d.]+"],
    "interpretation": [r"\b(this\s+(?:means|implies|suggests)|interpret|in\s+other\s+words|effectively)\b"],
    "conclusion": [r"\b(therefore|thus|hence|in\s+conclusion|as\s+a\s+result|consequently|overall|ultimately|in\s+short|the\s+lesson|takeaway|the\s+result\s+is)\b", r"^Summary\b", r"\bin\s+summary\b"],
    "mechanism": [r"\b(?:transmission|arbitrage|leverage|fluctuat(?:e|es|ing|ion))\b", r"\b(?:rate|price|premium|spread|return|portfolio|asset|liquidity|yield)\b", r"\b(?:leads?\s+to|caus(?:e|es|ing)|result(?:s|ing)\s+in|dri(?:ve|ves|ving)|trigge(?:r|rs|ring)|due\s+to|because\s+of)\b", r"\b(?:if|when).*(?:then|lead|result|cause|driven|triggered)\b", r"\b(?:impact(?:s|ing)?|influenc(?:e|es|ing)|affect(?:s|ing)?)\b", r"\b(?:mechanism|operation|functionality|process|result)\b"],
    "contrast": [r"\b(?:but|however|although|even\s+though|whereas|despite|nevertheless|nonetheless|conversely|on\s+the\s+contrary)\b", r"\b(?:instead\s+of|rather\s+than|as\s+opposed\s+to)\b", r"\b(?:while|yet)\b.*,"],
}
TAGS_EMBEDDING = {
    "definition": [r"\bdefined\s+as\b", r"\brefers\s+to\b", r"^[A-Z][a-z\s]+:\s"],
    "procedure": [r"^step\s+\d+", r"^firstly,", r"\bhow\s+to\b"],
    "example": [r"\bfor\s+example\b", r"\bfor\s+instance\b", r"\be\.g\.,"],
    "theorem": [r"^theorem\b", r"^lemma\b", r"^proof\b"],
}
# What the older tag tables have otherwise: weaker assumptions, fewer mechanisms; formulas, visual references and exercises.
_WEAK_ASSUMPTION = [r"\bassume\s+(?:that|we)\b", r"\bassuming\b", r"\bgiven\s+that\b", r"\bsuppose\s+(?:that|we)\b", r"\bunder\s+the\s+assumption\b"]
TAGS_LEGACY = TAGS | {"assumption": _WEAK_ASSUMPTION, "mechanism": [TAGS["mechanism"][0], *TAGS["mechanism"][2:]]}
TAGS_LEGACY_EMBEDDING = {k: v for k, v in TAGS.items() if k not in ("reference", "evidence", "interpretation", "conclusion", "mechanism", "contrast")} | {
    "assumption": _WEAK_ASSUMPTION,
    "formula": [r"\bequation\s+\d+", r"\bformula\s+(?:for|to)\b", r"\bwhere\s+[A-Z]\s*=", r"\b[A-Z]\s*=\s*[A-Z\d]", r"∑|∫|∂|√", r"\bderivative\s+of\b", r"\bintegral\s+of\b"],
    "visual_ref": [r"\bfigure\s+\d+", r"\btable\s+\d+", r"\bexhibit\s+\d+", r"\bsee\s+(?:figure|table)\b", r"\bas\s+shown\s+in\b", r"\billustrated\s+in\b"],
    "exercise": [r"^(?:Exercise|Problem|Question)\s*\d*", r"\bsolve\s+(?:the|for)\b", r"\bfind\s+the\s+value\b", r"\bcalculate\s+the\b", r"\bdetermine\s+(?:the|whether)\b"],
}
STRUCTURAL_HEADERS = [r"^(?:Chapter|Part|Section|Unit)\s+\d+", r"^\d+(?:\.\d+)*\s+[A-Z]", r"^(?:Appendix|Glossary|Index|Bibliography|References)", r"^(?:Summary|Conclusion|Introduction|Overview|Preface)"]
TOC_CANDIDATE_WORDS = ["contents", "table of contents", "index", "brief contents"]
TOC_PAGE_WORDS = ["contents", "table of contents", "index", "brief contents", "detailed contents"]
HEADING_LABELS = ["heading", "header", "title", "section_header"]
NOISE_LABELS = ["page_header", "page_footer", "footnote", "caption"]
ROLE_PRIORITY = ["theorem", "definition", "assumption", "conclusion", "contrast", "comparison", "evidence", "procedure", "mechanism", "interpretation", "limitation", "application", "example"]
HEADING_ROLES = {
    "example": "example", "case study": "example", "illustration": "example", "limitation": "limitation", "constraint": "limitation", "caveat": "limitation",
    "method": "procedure", "approach": "procedure", "procedure": "procedure", "how to": "procedure", "result": "evidence", "finding": "evidence",
    "data": "evidence", "empirical": "evidence", "conclusion": "conclusion", "summary": "conclusion", "takeaway": "conclusion",
    "definition": "definition", "what is": "definition", "assumption": "assumption", "hypothesis": "assumption",
}
SHORT_EXCEPTIONS = [r"\d+(?:\.\d+)?%", r"\$[\d,]+", r"(?:figure|table|exhibit)\s*\d", r"[=<>±]\s*\d", r"\b\d+\s*(?:bps|bp)\b"]
BOILERPLATE = [r"^\s*(see\s+(?:also|below|above)|continued|ibid)\s*$", r"\b(?:https?://|www\.|mhhe\.com)\b", r"\b(?:all\s+rights\s+reserved|copyright)\b", r"\bmcgraw\s*hill\b"]

# Page furniture.
NOISE_HEADERS = [
    r"^\s*\(?\s*concluded\s*\)?\s*$", r"^\s*\(?\s*continued\s*\)?\s*$", r"^\s*\(?\s*cont'?d?\s*\)?\s*$", r"^\s*\(?\s*continuation\s*\)?\s*$",
    r"^\s*continued\s+(?:on|from)\s+(?:next|previous)?\s*page", r"^\s*see\s+(?:next|previous)\s+page", r"^\s*to\s+be\s+continued",
]
FURNITURE = [*NOISE_HEADERS, r"^(?:Table|Figure|Exhibit)\s+[\d.]+\s*\(?\s*(?:continued|cont'?d?)\s*\)?", r"^\s*(?:Page\s+)?\d+\s*$", r"^\s*\d+\s*/\s*\d+\s*$", r"^\s*[-–—]\s*\d+\s*[-–—]\s*$"]
CAPTION_LIKE = r"^(?:Table|Figure|Fig\.?|Equation|Eq\.?)\s+\d+"
BREAK_TYPES = ["Header", "Table", "Picture", "Formula", "LearningObjective"]
CATALOG_TYPES = ["Figure", "Table", "Formula", "Picture", "Equation", "Header", "Title", "Paragraph", "Text"]

# Headings that are no structure.
LOGIC_NOISE = [
    r"^\d+[\s\d]+[A-Z]*[\s\d]+", r"^[A-Z]$", r"^(Table|Figure|Exhibit|Equation)\s+\d+", r"^(University of|Boston College|McGraw Hill|Printed in|All rights reserved)",
    r"^(Index|Name Index|Subject Index|Glossary)$", r"^[0-9\.\s]+$", r"^(E-INVESTMENTS|EXERCISES|Concept\s+Check|Summary|Key\s+Terms|Solutions|Web\s+Resources)",
    r"^(Source:|Concept Check|Visit\s+us\s+at)",
]
PATH_NOISE = [r"E-INVESTMENTS", r"EXERCISES", r"Concept Check", r"CONCEPT", r"Source:", r"Summary", r"Key Terms", r"\d+[\s\d]+LWI"]
BODY_START_TITLES = [r"^chapter\s+1\b", r"^part\s+i\b", r"^1\s+introduction", r"^1\.1\b"]
BACK_TITLES = [r"appendix", r"glossary", r"index", r"bibliography", r"references", r"name index", r"subject index"]
GATE_START = [r"^(?:Chapter|Section)\s*(?:1|I|ONE)\b", r"^1\.\s+[A-Z一-龥]", r"^第[一1]章"]
GATE_END = [r"^(?:Index|Bibliography|References|Appendix|Appendices)\b", r"^(?:索引|参考文献|附录|后记)"]
TOC_KEYWORDS = ["contents", "table of contents", "index", "目录", "brief contents", "detailed contents", "summary table of contents"]
SIDEBAR_HEADINGS = [r"^(?:chapter\s+)?objectives?", r"^learning\s+objectives?", r"^key\s+(?:terms?|points?|takeaways?|concepts?)", r"^summary", r"^highlights?", r"^(?:quick\s+)?review", r"^(?:in\s+)?this\s+chapter", r"^(?:margin(?:al)?|side)\s*(?:note|box)?"]
SIDEBAR_OBJECTIVES = [
    r"^(?:describe|explain|understand|identify|define|compare|calculate|evaluate|analyze|apply|discuss|list|summarize|provide|address|reacquaint|outline|review|introduce|show|demonstrate|determine|examine|evaluate|survey)\s+",
    r"^(?:LO|LOS|Learning\s+(?:Objective|Outcome))\s*\d*",
]
# Reference patterns: kind, pattern; the group is the id.
EXPLICIT_REFERENCES = [
    ("Figure", r"\b(?:Figure|Fig\.?)\s*(\d+(?:\.\d+)?(?:\s*\([a-z]\))?)"), ("Table", r"\b(?:Table|Tbl\.?)\s*(\d+(?:\.\d+)?)"),
    ("Equation", r"\b(?:Equation|Eq\.?)\s*\((\d+)\)"), ("Equation", r"\b(?:Formula)\s*\((\d+)\)"), ("Exhibit", r"\b(?:Exhibit)\s*(\d+(?:\.\d+)?)"),
]
IMPLICIT_REFERENCES = [
    ("above", r"\b(?:the|this)\s+(?:figure|table|chart|graph|diagram)\s+(?:above|shown above)"), ("above", r"\b(?:above|preceding)\s+(?:figure|table|chart)"),
    ("below", r"\b(?:the|this)\s+(?:figure|table|chart|graph|diagram)\s+(?:below|shown below)"), ("below", r"\b(?:following|below)\s+(?:figure|table|chart)"),
    ("this", r"\b(?:this|that)\s+(?:figure|table|equation|chart|diagram)"), ("see", r"\b(?:see|refer to)\s+(?:the\s+)?(?:figure|table)(?:\s+(?:above|below))?"),
]
EMBEDDING_ROLES = [
    ("definition", ["defined as", "refers to", "is a measure of", "is the proportion of"]), ("assumption", ["assume", "suppose", "given that", "let us", "assuming"]),
    ("limitation", ["limit", "caveat", "fails to", "not account for", "valid only", "not applicable"]),
    ("conclusion", ["conclude", "therefore", "summary", "takeaway", "consequently", "thus", "in summary", "overall"]),
]
# Weights of the continuation score, in the order in which they are added.
CONTINUATION_WEIGHTS = {"position": 0.15, "column": 0.10, "hyphen": 0.20, "open_clause": 0.15, "fragment": 0.10, "start": 0.15, "start_lowercase": 0.105, "same_path": 0.05, "same_type": 0.05, "incomplete": 0.40, "incomplete_lowercase": 0.30, "list_split": 0.50}
CONTINUATION_WEIGHTS_LEGACY = CONTINUATION_WEIGHTS | {"incomplete": 0.05, "incomplete_lowercase": 0.20, "list_split": 0.0}

# Roles of the older embedding profile, in order: role, patterns on the text in small letters, patterns on the text as it is.
EVIDENCE = [*TAGS["evidence"][:6], r"\b(?:CI|confidence\s+interval)\s*[=:\s]*", TAGS["evidence"][6], r"\b(?:ratio|rate|yield)\s+(?:of|is|was|=)\s*[\d.]+"]
ROLE_STAGES = [
    ("assumption", [r"\b(assume|assuming|given\s+that|suppose|provided\s+that|let\s+\w+\s+(?:be|equal|denote))\b"], [r"^(?:Suppose|Assume|Given|Let)\b"]),
    ("conclusion", [r"\b(therefore|thus|hence|in\s+conclusion|as\s+a\s+result|consequently|to\s+summarize|in\s+summary|the\s+takeaway)\b"], []),
    ("comparison", [r"\b(compared?\s+to|in\s+contrast|unlike|whereas|similarly|on\s+the\s+other\s+hand)\b", r"\b(more|less|greater|smaller|higher|lower|better|worse)\s+than\b"], [r"^(?:Unlike|Whereas|Similarly|In\s+contrast|Compared)\b"]),
    ("evidence", [], []),
    ("procedure", [r"\b(?:step\s+\d+|algorithm|methodology|follow\s+these\s+steps)\b"], [r"^(?:Step\s+\d|First,|Second,|Third,|Finally,|Next,|Then,)\s"]),
    ("definition", [r"\bis\s+(?:defined\s+as|the\s+\w+\s+(?:of|that))\b", r"\brefers?\s+to\b", r"\bmeans?\s+that\b"], [r"^[A-Z][a-z]+\s+is\s+a\s+(?:measure|type|form|kind|method|process)\b"]),
    ("formula", [r"\bequation\b", r"\bformula\b"], [r"[A-Z]\s*=\s*[A-Z\d(]", r"[=+*/^]{2,}"]),
    ("interpretation", [r"\b(this\s+(?:means|implies|suggests|indicates)|in\s+other\s+words|effectively|the\s+implication)\b"], []),
    ("mechanism", [r"\b(mechanism|works?\s+by|functions?\s+by|how\s+\w+\s+works?)\b"], []),
    ("limitation", [r"\b(limitation|constraint|caveat|does\s+not\s+(?:apply|work)|cannot\s+be\s+used|only\s+(?:works?|applies?)\s+(?:when|if|for))\b"], []),
    ("application", [r"\b(in\s+practice|applies?\s+to|used\s+(?:in|for|by)|practical|real-world|practitioners?)\b"], []),
    ("example", [r"\b(for\s+example|for\s+instance|such\s+as|consider\s+(?:a|the|this))\b", r"\be\.g\.\w"], [r"^(?:Consider|To\s+illustrate|As\s+an\s+example)\b"]),
]
STAGE_BOILERPLATE = [r"^\s*(see\s+(?:also|below|above)|page\s+\d+|continued|ibid)\s*$", r"\b(?:http|www\.\w|\.com|\.org)\b", r"\b(?:all\s+rights\s+reserved|copyright)\b"]
STAGE_REFERENCES = [r"(?i)(?:see|shown\s+in|as\s+in|from|per|refer\s+to|illustrated\s+in)\s+(?:Figure|Table|Exhibit)\s+\d", r"(?:Figure|Table|Exhibit)\s+\d+\s+(?:shows|presents|illustrates|displays|summarizes)", r"\((?:see\s+)?(?:Figure|Table|Exhibit)\s+\d+(?:\.\d+)?\)"]
NOT_IN_CONTEXT = {
    "example": [r"^\s*the\s+following\b", r"^\s*note\s+that\b"], "definition": [r"\bin\s+this\s+case\b", r"\bfor\s+example\b"],
    "formula": [r"\b\d+[- ](?:year|month|day|week|page|edition|class)\b", r"\b(?:pp\.|pages?)\s+\d+\b", r"\b(?:19|20)\d{2}\b", r"^[A-Z]\.\s"],
    "mechanism": [r"^(?:therefore|thus|hence|consequently)\b", r"\b(?:see|refer\s+to|illustrated\s+in)\b", r"\bthe\s+(?:lesson|summary|takeaway)\b"],
    "conclusion": [r"\bfor\s+example\b", r"\bif\s+we\s+assume\b"],
}
