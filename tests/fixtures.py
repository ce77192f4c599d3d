"""Small literal inputs for golden tests.

Fixed values: an offer menu (quantity, price) and a 14-node grid graph with its axis and
diagonal edge lists, as published with the original notebooks.
"""

OFFERS = [
    (4, "4.55"), (5, "5.70"), (6, "6.80"), (7, "7.95"), (8, "9.10"), (9, "10.20"), (10, "11.35"),
    (11, "12.50"), (12, "13.60"), (13, "14.75"), (14, "15.90"), (15, "17.00"), (16, "18.15"),
    (17, "19.30"), (18, "20.40"), (19, "21.55"), (20, "22.70"), (21, "23.80"), (22, "24.95"),
    (23, "26.10"), (24, "27.25"), (25, "27.80"), (26, "28.95"), (27, "30.10"), (28, "31.20"),
    (29, "32.35"), (30, "33.50"), (35, "39.15"), (40, "44.80"), (45, "50.50"), (50, "55.60"),
    (60, "67.00"), (70, "78.30"), (75, "83.45"), (80, "89.10"), (90, "100.45"), (100, "111.25"),
    (125, "139.00"), (150, "166.85"), (200, "222.50"),
]

NODES = {
    1: (3, 3), 2: (0, 2), 3: (1, 2), 4: (2, 2), 5: (3, 2), 6: (0, 1), 7: (1, 1), 8: (2, 1),
    9: (3, 1), 10: (0, 0), 11: (1, 0), 12: (2, 0), 13: (3, 0), 14: (3, -1),
}

AXIS_EDGES = [
    (1, 5), (2, 3), (3, 4), (4, 5), (2, 6), (3, 7), (4, 8), (5, 9), (6, 7), (7, 8), (8, 9),
    (6, 10), (7, 11), (8, 12), (9, 13), (10, 11), (11, 12), (12, 13), (13, 14),
]

DIAGONAL_EDGES = [
    (1, 2), (1, 3), (1, 4), (2, 7), (3, 6), (3, 8), (4, 7), (4, 9), (5, 8), (6, 11), (7, 10),
    (7, 12), (8, 11), (8, 13), (9, 12), (10, 14), (11, 14), (12, 14),
]
