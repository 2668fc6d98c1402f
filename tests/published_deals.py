"""The published deals with their archetypes, one per line.

Deal value, acquisition cost, days in stage, and H (high value, fast close), M (mid market,
standard) or L (long tail), in the published order.
"""

ROWS = """
8900 3260 7 L
51300 1180 13 L
127900 5350 10 H
199800 4190 3 H
31600 4500 6 L
60200 11760 10 M
38900 2450 8 L
74200 5930 13 M
94400 1810 9 H
21000 4510 3 L
28600 2350 2 L
101400 3090 10 H
164600 1050 6 H
97800 9600 3 M
23100 5330 13 M
83200 9420 9 M
99400 13420 14 M
77100 11260 5 M
84200 1410 14 H
95300 3360 5 H
58900 3480 12 L
10300 3660 1 L
43300 2150 8 L
31300 1900 7 L
17700 6990 6 L
20100 4190 2 L
18500 3980 6 L
29200 1860 6 L
28200 5980 10 M
16200 3620 5 L
38700 2740 3 L
41100 13950 13 M
21600 3480 8 L
90100 2740 11 H
205100 6870 2 H
26300 4850 9 L
93000 3330 3 L
21200 7580 8 M
13000 6240 3 L
102400 3170 14 H
74100 10490 4 M
74400 5700 3 L
20300 1450 9 L
37900 2670 4 L
81600 2400 13 H
49600 3190 3 L
49900 4600 3 L
21000 5440 4 L
65100 5390 1 L
24300 10460 1 M
93400 1790 1 L
70000 3990 14 H
22200 7020 5 L
95700 2710 5 H
25700 3340 8 L
37100 4370 6 L
25800 7120 11 M
18400 7690 8 M
9100 3700 11 L
48300 4990 9 L
58300 5950 5 L
168000 5680 5 H
142000 1770 6 H
66000 3480 1 L
58100 4970 13 M
35000 5630 11 M
30900 5260 9 L
40800 6740 10 M
26400 11790 14 M
37000 5420 9 L
24200 1360 2 L
16900 2940 13 L
86700 7800 3 M
26100 2590 5 L
163200 2370 1 H
42000 9440 14 M
52300 10630 13 M
29000 2000 13 L
42600 2330 2 L
122000 4510 11 H
28300 2980 12 L
24000 2350 5 L
38600 12010 9 M
35700 2310 7 L
51000 1800 3 L
43400 10680 5 M
25900 7230 10 M
75500 2240 8 L
175200 3870 12 H
17800 3630 13 L
9400 7420 7 M
27900 1660 12 L
81900 1830 8 H
66700 6160 6 L
50100 4850 8 L
144700 8280 13 H
114500 5630 6 H
204600 2920 12 H
104700 2400 11 H
38100 10370 5 M
22000 3750 4 L
28800 2700 11 L
157900 1640 8 H
82100 8000 11 M
92900 8510 2 M
50500 2160 10 L
52700 6390 10 M
58200 1150 7 L
18800 2020 9 L
21900 9900 13 M
162900 2440 11 H
23400 2110 13 L
52400 3130 2 L
38300 6640 14 M
22700 3260 12 L
109000 1820 1 H
72700 7570 13 M
71600 8740 4 M
20500 5270 2 L
13800 3940 4 L
58300 6780 3 L
66600 7750 14 M
98900 2370 10 H
13300 1910 3 L
22400 6110 3 L
50500 6330 8 M
17200 4970 6 L
"""
