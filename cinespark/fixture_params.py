"""

The fixture data has fewer credits per person than the real catalogue, so
thresholds are lower than the reference defaults; people are selected by
rank (never by literal id), so one text fits every scale factor.
"""

AS_OF_YEAR = 2023
ACTOR_MIN = 5              # M9, reference 30
DIRECTOR_MIN = 3           # M9, reference 12
ACTOR_SERVING_MIN = 10     # S3, reference 10
DIRECTOR_SERVING_MIN = 3   # S3, reference 10 (largest director nb_film is 8 at sf0.01)
SELECT_RANK = 3            # people with rank <= 3 form the D1/D2/D7 selections
GENRES = ["blue", "ring", "Sci-Fi", "News"]
DECADES = [1970, 1980, 1990]
NOTES = [4, 5, 6]
DEEP_PAGE = 12             # D8: page numbers jumped to, without and with facet filters
DEEP_PAGE_FILTERED = 2
# feature names of all genres of the fixture data (p_name words and the two fixed ones)
GENRE_VOCABULARY = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "news", "old", "plate",
                    "red", "ring", "rod", "sci_fi", "small", "widget"]
