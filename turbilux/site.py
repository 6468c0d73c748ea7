"""Site layout and measurement constants.

Fixed values: they must equal the field study's for right results.
"""

# rolling window of the trial series, seconds
ROLLING_WINDOW_SECONDS = 300
# minutes shown before and after a trial
SERIES_PAD_MINUTES = 20
# attenuation is drawn on the intensity axis multiplied by this
AXIS_SCALE = 100.0

# track and zone borders, feet
TRACK_BREAKS = (0.0, 100.0, 200.0, 300.0)
ZONE_BREAKS = (0.0, 50.0, 100.0, 200.0)
# labels of the intervals between the breaks, from low to high coordinate
TRACK_LABELS = ("3", "2", "1")
ZONE_LABELS = ("A", "B", "C")
# label of everything below the first break
UNCLASSIFIED = "U"
# drawing order of the levels; the ordinal is the 1-based position
TRACK_LEVELS = ("1", "2", "3", "U")
ZONE_LEVELS = ("U", "A", "B", "C")

# a pole nearer than BORDER_FUDGE to a border counts for both sides
BORDER_FUDGE = 3.5
LEGACY_BORDER_WIDTH = 1.0
LEGACY_BORDER_SHIFT = 2.0

# exact coordinate -> (start, end) of the drawn disturbance segment, in ordinals
SEGMENT_X = {
    0.0: (3.5, 3.5),
    100.0: (2.5, 2.5),
    50.0: (2.5, 3.5),
    150.0: (1.5, 2.5),
    250.0: (0.5, 1.5),
}
SEGMENT_Y = {
    0.0: (1.5, 1.5),
    100.0: (3.5, 3.5),
    25.0: (1.5, 2.5),
    75.0: (2.5, 3.5),
    150.0: (3.5, 4.5),
}

# name of the point at which the disturbance took place
DISTURBANCE_POINT = "X"

# cells of a metadata sheet that mean "missing"
NA_TOKENS = ("na", "NA", "", "?")
# trial dates left out of the analysis, and of the disturbance segments
EXCLUDED_TRIAL_DATES = ("2022-06",)
EXCLUDED_SEGMENT_DATES = ("2022-06", "2022-11-09")
EVENT_MARK = "Logged"
