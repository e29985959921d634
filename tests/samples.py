"""Short invented documents with the sectioning traps (not reference data)."""

CV_A = """Jordan Example
Lagos, 2020
Summary
Careful analyst who likes clean ledgers.
Views budgets as stories; reviews, previews and overviews.
Highlights
Excel • Access • QuickBooks
Education
Bachelor of Arts : Economics , June 2012
City College
Experience
Junior Analyst
March 2013 to May 2015 Some Firm
- Reconciled accounts in 2014
- Built reports

Senior Analyst
2015 to 2019 Other Firm
Led a team of four across the 2016 and 2017 audit seasons while also mentoring staff
Experience with Java and other tools noted here
Interests
chess, running
Skills
- Tools: Excel, SQL; Python.
python,  R, Spark
• Languages: English, French
Stack: a, b: c
Data: cleaning, modelling.
Additional Information
Available from January.
Summary
Replaced summary text.
"""

CV_NO_HEADING = "Just a note\nwithout any section heading at all\n"

CV_TRICKY = ("   \n"
             "SUMMARY:\n"
             "one\r\n"
             "Professional Experiences and much more text after it here\n"
             "Work   History\n"
             "x y\n"
             "Technical Skills:   \n"
             "a;b ; c\n"
             "Education & Training\n"
             "Certificates\n"
             "Personal   Information\n"
             "about me\n"
             "tail\n")

DOCS = [(1, CV_A), (2, CV_NO_HEADING), (3, CV_TRICKY), (4, ""), (5, "Skills\n")]
