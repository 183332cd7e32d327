"""Golden rows: titles and matches with what they must come to, as literals.

Part are rows of published inventories: the titles from "Department of Africana Studies" on, and the matches after
the first eleven.  The others were taken from the engine's results and read over against the rules, so they
guard against change more than they prove.  Queries deal them to the rows of generated tables, and
their SQL joins them as values.
"""

from __future__ import annotations

#: raw title, source, kind, bucket, label, confidence, reasons
TITLES = (
    ("African American Studies", "crawl", "program", "black", "African American Studies", 70, "bare_studies_name|bucket_match:black"),
    ("African American Studies", "cv", "program", "black", "African American Studies", 90, "bare_studies_name|bucket_match:black|cv_bonus"),
    ("Black Studies Program", "crawl", "program", "black", "Black Studies", 90, "strong_token|anchor_phrase|bucket_match:black"),
    ("Africana Studies (BA)", "crawl", "program", "africana", "Africana Studies", 70, "degree_token|anchor_phrase|bucket_match:africana"),
    ("Africana Studies (AFST)", "crawl", "other_nonprogram", "africana", "Africana Studies", 30, "anchor_phrase|bucket_match:africana"),
    ("Africana Studies Major and Minor", "crawl", "program", "africana", "Africana Studies", 100, "strong_token|anchor_phrase|compound_anchor|bucket_match:africana"),
    ("Middle East and North African Studies", "cv", "program", "mena", "Middle East and North Africa Studies", 100, "bare_studies_name|anchor_phrase|compound_anchor|bucket_match:mena|cv_bonus"),
    ("Middle Eastern Studies and Islamic Studies", "crawl", "program", "mena", "Middle Eastern and North African Studies", 70, "bare_studies_name|bucket_match:mena"),
    ("Near Eastern Languages", "crawl", "other_nonprogram", "mena", "Near Eastern Languages", 10, "bucket_match:mena"),
    ("African Studies Minor", "crawl", "program", "african", "African Studies", 90, "strong_token|anchor_phrase|bucket_match:african"),
    ("African Studies", "cv", "program", "african", "African Studies", 100, "bare_studies_name|anchor_phrase|bucket_match:african|cv_bonus"),
    ("Ethnic Studies", "crawl", "program", "ethnic", "Ethnic Studies", 90, "bare_studies_name|anchor_phrase|bucket_match:ethnic"),
    ("Ethnic Studies (Pan African Studies)", "crawl", "other_nonprogram", "africana", "Ethnic Studies (Pan African Studies)", 30, "anchor_phrase|bucket_match:africana"),
    ("Race and Ethnic Studies", "crawl", "program", "race", "Race and Ethnic Studies", 100, "bare_studies_name|anchor_phrase|compound_anchor|bucket_match:race"),
    ("African, Black and Caribbean Studies", "crawl", "program", "black", "African, Black and Caribbean Studies", 70, "bare_studies_name|bucket_match:black"),
    ("African &amp; African American Studies", "crawl", "program", "black", "African and African American Studies", 100, "bare_studies_name|anchor_phrase|compound_anchor|bucket_match:black"),
    ("African &amp; African American Studies", "cv", "program", "black", "African and African American Studies", 100, "bare_studies_name|anchor_phrase|compound_anchor|bucket_match:black|cv_bonus"),
    ("Black Belt Training", "crawl", "junk", "", "", 0, ""),
    ("North African Studies", "crawl", "program", "mena", "North African Studies", 90, "bare_studies_name|anchor_phrase|bucket_match:mena"),
    ("Introduction to Black Studies", "crawl", "course", "black", "Introduction to Black Studies", 10, "bare_studies_name|anchor_phrase|bucket_match:black|course_like"),
    ("Black Student Union News", "crawl", "junk", "", "", 0, ""),
    ("Class of 2019 Graduates", "crawl", "junk", "", "", 0, ""),
    ("The Class of ’19", "crawl", "other_nonprogram", "", "", 0, ""),
    ("BA in Ethnic Studies", "crawl", "program", "ethnic", "Ethnic Studies", 100, "degree_token|degree_phrase|bare_studies_name|anchor_phrase|bucket_match:ethnic"),
    ("Bachelor of Arts in Africana Studies", "crawl", "program", "africana", "Africana Studies", 100, "degree_phrase|bare_studies_name|anchor_phrase|bucket_match:africana"),
    ("Racial Justice Certificate", "crawl", "program", "race", "Racial Justice Certificate", 70, "strong_token|bucket_match:race"),
    ("Major in Critical Race Studies", "crawl", "program", "race", "Major in Critical Race Studies", 100, "strong_token|bare_studies_name|bucket_match:race"),
    ("Travel to Ghana", "crawl", "event_news", "", "", 0, ""),
    ("Scholarship for Black Studies", "crawl", "junk", "black", "Scholarship for Black Studies", 10, "bare_studies_name|anchor_phrase|bucket_match:black|descriptor_nonprogram"),
    ("AFAM 201 Black Literature", "crawl", "course", "", "", 0, ""),
    ("Ethnic Studies is offered as a major, minor, and concentration", "crawl", "program", "ethnic", "Ethnic Studies", 100, "strong_token|anchor_phrase|compound_anchor|bucket_match:ethnic"),
    ("Ethnic, Cultural Minority, and Gender Studies, Other", "cv", "program", "minority", "Ethnic, Cultural Minority, and Gender Studies, Other", 100, "cv_taxonomy_target|bucket_match:minority|cv_bonus"),
    ("Ethnic, Cultural Minority, and Gender Studies, Other", "crawl", "other_nonprogram", "minority", "Ethnic, Cultural Minority, and Gender Studies, Other", 10, "bucket_match:minority"),
    ("Black and Latino Studies - Minor", "crawl", "program", "black", "Black and Latino Studies -", 70, "strong_token|bucket_match:black"),
    ("Jane Doe - Africana Studies", "crawl", "other_nonprogram", "africana", "Jane Doe - Africana Studies", 30, "bare_studies_name|anchor_phrase|bucket_match:africana|profile_dash"),
    ("Mathematics", "crawl", "other_nonprogram", "", "", 0, ""),
    ("Why study Africa?", "crawl", "other_nonprogram", "african", "Why study Africa?", 0, "bucket_match:african|story_marker"),
    ("", "crawl", "junk", "", "", 0, ""),
    ("Africana", "crawl", "other_nonprogram", "africana", "Africana Studies", 10, "bucket_match:africana"),
    ("Africana (M, m)", "crawl", "maybe_program", "africana", "Africana Studies", 50, "major_minor_shorthand|bucket_match:africana"),
    ("Majors and Minors: Africana Studies", "crawl", "program", "africana", "Africana Studies", 100, "bare_studies_name|anchor_phrase|compound_anchor|bucket_match:africana"),
    ("Welcome to Africana Studies", "crawl", "junk", "africana", "Africana Studies", 90, "bare_studies_name|anchor_phrase|bucket_match:africana"),
    ("Ethnic Studies and Women's, Gender, and Sexuality Studies", "crawl", "program", "ethnic", "Ethnic Studies", 70, "anchor_phrase|compound_anchor|bucket_match:ethnic"),
    ("African and African Diaspora Studies African and African Diaspora Studies", "crawl", "other_nonprogram", "african", "African and African Diaspora Studies", 10, "bucket_match:african"),
    ("Africana Studies Home,", "crawl", "other_nonprogram", "africana", "Africana Studies", 30, "anchor_phrase|bucket_match:africana"),
    ("The Department of Black Studies", "crawl", "department_unit", "black", "Black Studies", 100, "strong_token|bare_studies_name|anchor_phrase|bucket_match:black"),
    ("Department of Black Studies, BA", "crawl", "program", "black", "Black Studies, BA", 100, "strong_token|degree_token|anchor_phrase|bucket_match:black"),
    ("Ａfrican Studies – Minor", "crawl", "program", "african", "African Studies -", 90, "strong_token|anchor_phrase|bucket_match:african"),
    ("African Studies Ã©tudes", "crawl", "other_nonprogram", "african", "African Studies études", 30, "anchor_phrase|bucket_match:african"),
    ("Africology", "crawl", "other_nonprogram", "africana", "Africology", 10, "bucket_match:africana"),
    ("Cultural Minority Studies", "cv", "program", "minority", "Cultural Minority Studies", 90, "bare_studies_name|bucket_match:minority|cv_bonus"),
    ("Race/Ethnicity", "cv", "other_nonprogram", "ethnic", "Race/Ethnicity", 30, "bucket_match:ethnic|cv_bonus"),
    ("Students reads into Ethnic Studies", "crawl", "event_news", "ethnic", "Students reads into Ethnic Studies", 30, "bare_studies_name|anchor_phrase|bucket_match:ethnic|story_marker"),
    ("Ethnic Studies Curriculum Guide", "crawl", "course", "ethnic", "Ethnic Studies Curriculum Guide", 0, "anchor_phrase|bucket_match:ethnic|admin_marker|course_like"),
    ("African Languages Lab", "crawl", "center_institute", "african", "African Languages Lab", 10, "bucket_match:african"),
    ("Pan-African Studies", "crawl", "program", "africana", "Pan-African Studies", 90, "bare_studies_name|anchor_phrase|bucket_match:africana"),
    ("Black Visual Cultures Initiative", "crawl", "center_institute", "black", "Black Visual Cultures Initiative", 10, "bucket_match:black"),
    ("Seminar in Black Studies Major", "crawl", "program", "black", "Seminar in Black Studies", 90, "strong_token|anchor_phrase|bucket_match:black"),
    ("Introduction to the Africana Studies Major", "crawl", "program", "africana", "Introduction to the Africana Studies", 90, "strong_token|anchor_phrase|bucket_match:africana"),
    ("Study of the many peoples of the African continent and of how they have lived together over time", "crawl", "other_nonprogram", "", "", 0, "sentence_like"),
    ("Department of Africana Studies", "crawl", "department_unit", "africana", "Africana Studies", 100, "strong_token|bare_studies_name|anchor_phrase|bucket_match:africana"),
    ("Pan African Center", "crawl", "center_institute", "africana", "Pan African Center", 10, "bucket_match:africana"),
    ("Department of Pan-African Studies", "crawl", "department_unit", "africana", "Pan-African Studies", 100, "strong_token|bare_studies_name|anchor_phrase|bucket_match:africana"),
    ("Africana Studies Department", "crawl", "department_unit", "africana", "Africana Studies Department", 90, "strong_token|anchor_phrase|bucket_match:africana"),
    ("African and African American Studies Department", "crawl", "department_unit", "black", "African and African American Studies", 100, "strong_token|anchor_phrase|compound_anchor|bucket_match:black"),
    ("Department of African and African American Studies", "crawl", "department_unit", "black", "African and African American Studies", 100, "strong_token|anchor_phrase|compound_anchor|bucket_match:black"),
    ("Center for Race, Inequality and Social Equity Studies (CRISES)", "crawl", "center_institute", "race", "Center for Race, Inequality and Social Equity Studies", 10, "bucket_match:race"),
    ("Harvard University Center for African Studies", "crawl", "center_institute", "african", "Harvard University Center for African Studies", 90, "bare_studies_name|anchor_phrase|bucket_match:african"),
    ("Black Men's Research Institute", "crawl", "center_institute", "other", "Black Men's Research Institute", 0, "course_like"),
    ("African Summer Institute (AFSI)", "crawl", "center_institute", "other", "African Summer Institute", 0, ""),
    ("African American and African Studies, Department of", "crawl", "department_unit", "black", "African American and African Studies, Department of", 100, "strong_token|anchor_phrase|compound_anchor|bucket_match:black"),
    ("Conference Center, Blackwell Inn and", "crawl", "center_institute", "other", "Conference Center, Blackwell Inn and", 0, ""),
    ("Department of African American Studies", "crawl", "department_unit", "black", "African American Studies", 100, "strong_token|bare_studies_name|bucket_match:black"),
    ("Black Resource Center", "crawl", "center_institute", "other", "Black Resource Center", 0, ""),
    ("\"A Historic Celebration\": Black Studies Becomes a Department and Major", "crawl", "department_unit", "black", "\"A Historic Celebration\": Black Studies Becomes a Department and", 100, "strong_token|anchor_phrase|compound_anchor|bucket_match:black"),
    ("Africology and African American Studies Department", "crawl", "department_unit", "black", "Africology and African American Studies Department", 70, "strong_token|bucket_match:black"),
    ("Department of African and African Diaspora Studies", "crawl", "department_unit", "african", "African and African Diaspora Studies", 70, "strong_token|bucket_match:african"),
    ("Ethnic Studies Department", "crawl", "department_unit", "ethnic", "Ethnic Studies Department", 90, "strong_token|anchor_phrase|bucket_match:ethnic"),
    ("Institute for the Study of Ancient Cultures, West Asia and North Africa (ISAC)", "crawl", "center_institute", "mena", "Institute for the Study of Ancient Cultures, West Asia and North Africa", 0, "bucket_match:mena|sentence_like"),
    ("African Studies, Center For", "crawl", "center_institute", "african", "African Studies, Center For", 30, "anchor_phrase|bucket_match:african"),
    ("UH Celebrates First African American Studies Department Graduate", "crawl", "department_unit", "black", "UH Celebrates First African American Studies Department Graduate", 70, "strong_token|bucket_match:black"),
    ("the Kansas African Studies Center", "crawl", "center_institute", "african", "Kansas African Studies Center", 30, "anchor_phrase|bucket_match:african"),
)

#: title, strict key, loose key, bare label, with synonyms, tokens, families, flags, class if third-party only, without prefix, strict and loose key of page titles
COMPARED = (
    ("Africana Studies", "africana studies", "africana studies", "Africana Studies", "Africana Studies", "africana|studies", "africana", "strong|rename|taxonomy|academic", "taxonomy", "Africana Studies", "africana studies", "africana studies"),
    ("African-American Studies Dept.", "african-american studies dept.", "african-american studies dept.", "African-American Studies Dept.", "african american Studies department .", "african|american|dept.|studies", "black|african", "signal|strong|rename|academic", "primary_academic", "African-American Studies Dept.", "african-american studies dept", "african-american studies dept"),
    ("BA in Ethnic Studies", "ba in ethnic studies", "ethnic studies", "Ethnic Studies", "BA in Ethnic Studies", "ethnic|studies", "ethnic", "academic", "primary_academic", "BA in Ethnic Studies", "ba in ethnic studies", "ba ethnic studies"),
    ("Bachelor of Arts in Black Studies (Minor)", "bachelor of arts in black studies (minor)", "arts black studies ( )", "Black Studies", "Bachelor of Arts in africana studies (Minor)", "arts|black|studies", "black", "credential|strong|rename|academic", "primary_academic", "Bachelor of Arts in Black Studies (Minor)", "bachelor of arts in black studies minor", "bachelor arts black studies"),
    ("Center for Race, Ethnicity & Equity", "center for race, ethnicity and equity", "center race, ethnicity equity", "Center for Race, Ethnicity and Equity", "Center for Race, Ethnicity and Equity", "center|equity|ethnicity|race,", "ethnic|race", "signal|organisation", "secondary_org", "Center for Race, Ethnicity & Equity", "center for race ethnicity and equity", "center race ethnicity equity"),
    ("African Studies", "african studies", "african studies", "African Studies", "African Studies", "african|studies", "african", "taxonomy|academic", "taxonomy", "African Studies", "african studies", "african studies"),
    ("Women's and Gender Studies", "womens and gender studies", "womens gender studies", "Women's and Gender Studies", "women and Gender Studies", "gender|studies|womens", "", "academic", "primary_academic", "Women's and Gender Studies", "womens and gender studies", "women s gender studies"),
    ("Pan African Studies", "pan african studies", "pan african studies", "Pan African Studies", "africana studies", "african|pan|studies", "black|africana|african", "rename|taxonomy|academic", "taxonomy", "Pan African Studies", "pan african studies", "pan african studies"),
    ("Africology", "africology", "africology", "Africology", "africana studies", "africology", "", "fragment", "other", "Africology", "africology", "africology"),
    ("and Gender Studies", "and gender studies", "gender studies", "and Gender Studies", "and Gender Studies", "gender|studies", "", "fragment|taxonomy|academic", "taxonomy", "and Gender Studies", "and gender studies", "gender studies"),
    ("Ethnic", "ethnic", "ethnic", "Ethnic", "Ethnic", "ethnic", "ethnic", "fragment", "other", "Ethnic", "ethnic", "ethnic"),
    ("About the Program", "about the program", "about program", "About the Program", "About the Program", "about|program", "", "navigation|nonprogram|academic", "primary_academic", "About the Program", "about the program", "about"),
    ("Faculty and Staff Meeting", "faculty and staff meeting", "faculty staff meeting", "Faculty and Staff Meeting", "Faculty and Staff Meeting", "faculty|meeting|staff", "", "signal|nonprogram", "other", "Faculty and Staff Meeting", "faculty and staff meeting", "faculty staff meeting"),
    ("Black Studies Minor 2024-25", "black studies minor 2024-25", "black studies 2024-25", "Black Studies Minor 2024-25", "africana studies Minor 2024-25", "2024|black|studies", "black", "credential|strong|rename|year|academic", "primary_academic", "Black Studies Minor 2024-25", "black studies minor 2024-25", "black studies 2024-25"),
    ("Check out the Ethnic Studies Program", "check out the ethnic studies program", "check out ethnic studies program", "Check out the Ethnic Studies Program", "Check out the Ethnic Studies Program", "check|ethnic|out|program|studies", "ethnic", "navigation|nonprogram|academic", "primary_academic", "Check out the Ethnic Studies Program", "check out the ethnic studies program", "check out ethnic studies"),
    ("Why Africana?", "why africana?", "why africana?", "Why Africana?", "Why Africana?", "africana?|why", "africana", "strong|rename|navigation|nonprogram", "other", "Why Africana?", "why africana", "why africana"),
    ("Department of African and African American Studies", "department of african and african american studies", "department african african american studies", "Department of African and African American Studies", "Department of African and African American Studies", "african|american|department|studies", "black|african", "signal|strong|rename|academic", "primary_academic", "Department of African and African American Studies", "department of african and african american studies", "african african american studies"),
    ("Latinx/Chicanx Studies_Program", "latinx chicanx studies program", "latinx chicanx studies program", "Latinx/Chicanx Studies_Program", "Latinx/Chicanx Studies_Program", "chicanx|latinx|program|studies", "ethnic", "", "other", "Latinx/Chicanx Studies_Program", "latinxchicanx studies_program", "latinx chicanx studies_program"),
    ("Multi-Ethnic Studies Program", "multi-ethnic studies program", "multi-ethnic studies program", "Multi-Ethnic Studies Program", "Multi-Ethnic Studies Program", "ethnic|multi|program|studies", "ethnic", "academic", "primary_academic", "Multi-Ethnic Studies Program", "multi-ethnic studies program", "multi-ethnic studies"),
    ("Migration and Social Justice Certificate", "migration and social justice certificate", "migration social justice", "Migration and Social Justice Certificate", "Migration and Social Justice Certificate", "justice|migration|social", "ethnic|race", "credential|academic", "primary_academic", "Migration and Social Justice Certificate", "migration and social justice certificate", "migration social justice"),
    ("Afro-American and Carribbean Studies, Ph.D.", "afro-american and carribbean studies, ph.d.", "afro-american carribbean studies, .", "Afro-American and Carribbean Studies, Ph.D.", "african american and caribbean Studies, Ph.D.", "afro|american|carribbean|studies,", "black", "strong|rename|academic", "primary_academic", "Afro-American and Carribbean Studies, Ph.D.", "afro-american and carribbean studies phd", "afro-american carribbean studies ph d"),
    ("Master of Arts in Race and Justice", "master of arts in race and justice", "arts race justice", "Race and Justice", "Master of Arts in Race and Justice", "arts|justice|race", "race", "", "other", "Master of Arts in Race and Justice", "master of arts in race and justice", "master arts race justice"),
    ("department_unit:africana:crawl:Africana Studies", "department unit:africana:crawl:africana studies", "department unit:africana:crawl:africana studies", "department_unit:africana:crawl:Africana Studies", "department_unit:africana:crawl:Africana Studies", "department|studies|unit:africana:crawl:africana", "africana", "strong|rename|taxonomy|academic", "taxonomy", "Africana Studies", "department_unitafricanacrawlafricana studies", "department_unit africana crawl africana studies"),
    ("program_signal:black:cv:Black Studies", "program signal:black:cv:black studies", "program signal:black:cv:black studies", "program_signal:black:cv:Black Studies", "program_signal:black:cv: africana studies", "program|signal:black:cv:black|studies", "black", "strong|rename|taxonomy|academic", "taxonomy", "program_signal:black:cv:Black Studies", "program_signalblackcvblack studies", "program_signal black cv black studies"),
    ("Committee on Ethnic Studies", "committee on ethnic studies", "committee on ethnic studies", "Committee on Ethnic Studies", "Committee on Ethnic Studies", "committee|ethnic|studies", "ethnic", "signal|nonprogram|academic|organisation", "secondary_org", "Committee on Ethnic Studies", "committee on ethnic studies", "committee on ethnic studies"),
    ("Queer Studies", "queer studies", "queer studies", "Queer Studies", "Queer Studies", "queer|studies", "", "taxonomy|academic", "taxonomy", "Queer Studies", "queer studies", "queer studies"),
    ("Mathematics", "mathematics", "mathematics", "Mathematics", "Mathematics", "mathematics", "", "fragment", "other", "Mathematics", "mathematics", "mathematics"),
    ("Welcome to the BA BS MA Major Minor page of the school where every program and each degree is named with its own long list of classes", "welcome to the ba bs ma major minor page of the school where every program and each degree is named with its own long list of classes", "welcome to page school where every program each degree is named with its own long list classes", "Welcome to the BA BS MA Major Minor page of the school where every program and each degree is named with its own long list of classes", "Welcome to the BA BS MA Major Minor page of the school where every program and each degree is named with its own long list of classes", "classes|degree|each|every|its|list|long|named|own|page|program|school|welcome|where|with", "", "signal|credential|navigation|nonprogram|mega|academic", "primary_academic", "Welcome to the BA BS MA Major Minor page of the school where every program and each degree is named with its own long list of classes", "welcome to the ba bs ma major minor page of the school where every program and each degree is named with its own long list of classes", "welcome ba bs ma page school where every each degree is named with its own long list classes"),
)

#: reference title, cells of crawl, third party and signals
CELLS = (
    ("Africana Studies", "Africana Studies|Black Studies|Other", "", "center_institute:race:crawl:Center for Race || committee_admin:ethnic:cv:Ethnic Council"),
    ("X", "African, Black and Caribbean Studies; Music", "Ethnic, Cultural Minority, and Gender Studies, Other", ""),
    ("Y", "Art, Music, Dance", "Ethnic|Cultural Studies|Other", ""),
    ("Z", "Department of Music", "", ""),
    ("", "", "", ""),
    ("W", "a|b", "", ""),
)

#: number of the cells above, place, title, source, kind
CANDIDATES = (
    (0, 0, "Africana Studies Black Studies Other", "crawl", "program"),
    (0, 1, "Africana Studies Black Studies", "crawl", "program"),
    (0, 2, "Africana Studies", "crawl", "program"),
    (0, 3, "Black Studies", "crawl", "program"),
    (0, 4, "Other", "crawl", "program"),
    (0, 5, "Center for Race", "signal", "signal"),
    (0, 6, "Ethnic Council", "signal", "signal"),
    (1, 0, "African, Black and Caribbean Studies", "crawl", "program"),
    (1, 1, "Music", "crawl", "program"),
    (1, 2, "Ethnic, Cultural Minority, and Gender Studies, Other", "cv", "program"),
    (2, 0, "Art", "crawl", "program"),
    (2, 1, "Music", "crawl", "program"),
    (2, 2, "Dance", "crawl", "program"),
    (2, 3, "Ethnic Cultural Studies", "cv", "program"),
    (2, 4, "Ethnic / Cultural Studies / Other", "cv", "program"),
    (3, 0, "Department of Music", "crawl", "program"),
    (3, 1, "Department of Music", "signal", "signal"),
    (5, 0, "a", "crawl", "program"),
    (5, 1, "b", "crawl", "program"),
)

#: reference title, candidates (title, source, kind), and the match: title, source, kind, level, score, detail
MATCHES = (
    (
        "Ethnic Studies",
        (("ethnic studies", "crawl", "program"), ("Ethnic Studies Minor", "crawl", "program"),),
        ("ethnic studies", "crawl", "program", "related_domain_backstop", 1.0, "related_domain_backstop: ref=\"Ethnic Studies\" ~ cand=\"ethnic studies\" score=1.00 fam_ref=['ethnic'] fam_cand=['ethnic']"),
    ),
    (
        "Africana Studies",
        (("Africana Studies (ABD)", "crawl", "program"),),
        ("Africana Studies (ABD)", "crawl", "program", "related_domain_backstop", 1.0, "related_domain_backstop: ref=\"Africana Studies\" ~ cand=\"Africana Studies (ABD)\" score=1.00 fam_ref=['africana'] fam_cand=['africana']"),
    ),
    (
        "Black Studies",
        (("Africana Studies Program", "crawl", "program"), ("African Studies", "cv", "program"),),
        ("Africana Studies Program", "crawl", "program", "related_domain_backstop", 1.0, "related_domain_backstop: ref=\"Black Studies\" ~ cand=\"Africana Studies Program\" score=1.00 fam_ref=['black'] fam_cand=['africana']"),
    ),
    (
        "Africana Studies Department",
        (("Department of Africana Studies", "signal", "signal"), ("Africana Studies Major", "crawl", "program"),),
        ("Department of Africana Studies", "signal", "signal", "related_domain_backstop", 1.0, "related_domain_backstop: ref=\"Africana Studies Department\" ~ cand=\"Department of Africana Studies\" score=1.00 fam_ref=['africana'] fam_cand=['africana']"),
    ),
    (
        "Ethnic Studies Program",
        (("Race and Ethnicity Minor", "crawl", "program"), ("Ethnic Studies", "cv", "program"),),
        ("Ethnic Studies", "cv", "program", "winner_override", 1.0, "winner_override: patch1:taxonomy_backstop | ref=\"Ethnic Studies Program\" ~ cand=\"Ethnic Studies\" score=1.00"),
    ),
    (
        "Africana Studies",
        (("African Studies", "crawl", "program"),),
        ("African Studies", "crawl", "program", "rename_family_rescue", 0.867741935483871, "rename_family_rescue: ref=\"Africana Studies\" ~ cand=\"African Studies\" score=0.87 fam_ref=['africana'] fam_cand=['african'] cls=primary_academic african_only=1"),
    ),
    (
        "Music",
        (("Physics and Astronomy", "crawl", "program"),),
        ("Physics and Astronomy", "crawl", "program", "winner_override", 0.2727272727272727, "winner_override: patch1:best_available | ref=\"Music\" ~ cand=\"Physics and Astronomy\" score=0.27"),
    ),
    (
        "Center for Ethnic Studies",
        (("Center for Race and Ethnic Studies", "signal", "signal"), ("Ethnic Studies", "crawl", "program"),),
        ("Ethnic Studies", "crawl", "program", "winner_override", 1.0, "winner_override: replaced=\"Center for Race and Ethnic Studies\" (related_domain_backstop) -> \"Ethnic Studies\"; patch1:primary_academic | score=1.00"),
    ),
    (
        "Ethnic Studies",
        (("Ethnic Studies", "cv", "program"), ("News about Ethnic Studies", "crawl", "program"),),
        ("Ethnic Studies", "cv", "program", "strict_raw", 1.0, "strict_raw: ref=\"Ethnic Studies\" == cand=\"Ethnic Studies\""),
    ),
    (
        "",
        (("Ethnic Studies", "cv", "program"),),
        ("", "", "", "NO_MATCH", 0.0, ""),
    ),
    (
        "African American Studies",
        (("About African American Studies", "crawl", "program"), ("Check out the African American Studies Program", "crawl", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by nav_prefix filter cand=\"About African American Studies\" score=1.00"),
    ),
    (
        "African American Studies Department",
        (("Black Visual Cultures - Minor", "crawl", "program"), ("Minor in Black Visual Cultures", "crawl", "program"),),
        ("Black Visual Cultures - Minor", "crawl", "program", "winner_override", 0.34586206896551724, "winner_override: patch1:best_available | ref=\"African American Studies Department\" ~ cand=\"Black Visual Cultures - Minor\" score=0.35"),
    ),
    (
        "Black Studies Program",
        (("Reflecting Black Art Exhibit", "crawl", "program"),),
        ("Reflecting Black Art Exhibit", "crawl", "program", "winner_override", 0.27384615384615385, "winner_override: patch1:best_available | ref=\"Black Studies Program\" ~ cand=\"Reflecting Black Art Exhibit\" score=0.27"),
    ),
    (
        "Africana Studies Program",
        (("Georgia's First Public Historically Black College and University", "crawl", "program"), ("Georgia's First Public Historically Black College and University", "signal", "signal"),),
        ("Georgia's First Public Historically Black College and University", "crawl", "program", "winner_override", 0.27686746987951805, "winner_override: patch1:best_available | ref=\"Africana Studies Program\" ~ cand=\"Georgia's First Public Historically Black College and University\" score=0.28"),
    ),
    (
        "Africa and African American Studies Program",
        (("African American - African Diaspora African American - African Diaspora Art Histories with a Museum Studies Certificate, M.A. African American - African Diaspora Art Histories, M.A. African American - African Diaspora with a Museum Studies Certificate", "crawl", "program"), ("African American - African Diaspora", "crawl", "program"), ("African American - African Diaspora Art Histories with a Museum Studies Certificate, M.A.", "crawl", "program"), ("African American - African Diaspora Art Histories, M.A.", "crawl", "program"), ("African American - African Diaspora with a Museum Studies Certificate", "crawl", "program"),),
        ("African American - African Diaspora", "crawl", "program", "related_domain_backstop", 0.7866666666666666, "related_domain_backstop: ref=\"Africa and African American Studies Program\" ~ cand=\"African American - African Diaspora\" score=0.79 fam_ref=['african', 'black'] fam_cand=['african', 'africana', 'black']"),
    ),
    (
        "African and African American Studies Program",
        (("Oldest known cremation pyre in Africa reveals mysterious woman who lived 9,500 years ago", "crawl", "program"), ("Volcanoes may have helped spread the Black Death", "crawl", "program"),),
        ("Volcanoes may have helped spread the Black Death", "crawl", "program", "winner_override", 0.3342857142857143, "winner_override: patch1:best_available | ref=\"African and African American Studies Program\" ~ cand=\"Volcanoes may have helped spread the Black Death\" score=0.33"),
    ),
    (
        "African American Studies Program",
        (("Race and Pedagogy Institute", "crawl", "program"), ("Race and Pedagogy Institute", "signal", "signal"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by strong_ref_gate filter cand=\"Race and Pedagogy Institute\" score=0.10"),
    ),
    (
        "Africana Studies Program",
        (("Ethnic Studies", "crawl", "program"), ("African Studies", "cv", "program"), ("Ethnic", "cv", "program"), ("Cultural Minority", "cv", "program"), ("and Gender Studies", "cv", "program"), ("Other", "cv", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by cv_taxonomy_backstop filter cand=\"African Studies\" score=0.67"),
    ),
    (
        "Culture, Race and Ethnicity Center",
        (("Race", "crawl", "program"), ("Power", "crawl", "program"), ("and Resistance (B.A.)", "crawl", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_raw: suppressed fragment candidate cand=\"and Resistance (B.A.)\" score=0.12"),
    ),
    (
        "Africana and Latino Studies Department",
        (("ANTH 3450 - Race", "crawl", "program"), ("Genetics", "crawl", "program"), ("and Variation 3 s.h.", "crawl", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by strong_ref_gate filter cand=\"and Variation 3 s.h.\" score=0.31"),
    ),
    (
        "African American Studies Center",
        (("Ethnic studies", "crawl", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by strong_ref_gate filter cand=\"Ethnic studies\" score=0.45"),
    ),
    (
        "Africana Studies Program",
        (("Race and Ethic Studies", "crawl", "program"), ("Race and Ethnic Studies", "crawl", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by strong_ref_gate filter cand=\"Race and Ethic Studies\" score=0.52"),
    ),
    (
        "African American and Africana Studies Program",
        (("Ethnic, Cultural Minority, and Gender Studies, Other", "cv", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by strong_ref_gate filter cand=\"Ethnic, Cultural Minority, and Gender Studies, Other\" score=0.36"),
    ),
    (
        "Black Studies Program",
        (("Race, Ethnic and Gender Studies (REGS)", "crawl", "program"), ("Race", "crawl", "program"), ("Ethnic", "crawl", "program"), ("and Gender Studies", "crawl", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by strong_ref_gate filter cand=\"and Gender Studies\" score=0.50"),
    ),
    (
        "Africana Studies Program",
        (("Global", "crawl", "program"), ("Government", "crawl", "program"), ("and Ethnic Studies", "crawl", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by strong_ref_gate filter cand=\"and Ethnic Studies\" score=0.53"),
    ),
    (
        "African American Studies Department",
        (("Race", "crawl", "program"), ("Religion", "crawl", "program"), ("Gender", "crawl", "program"), ("and Multidisciplinary Studies Department", "crawl", "program"), ("Race", "signal", "signal"), ("Religion", "signal", "signal"), ("Gender", "signal", "signal"), ("and Multidisciplinary Studies Department", "signal", "signal"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by strong_ref_gate filter cand=\"and Multidisciplinary Studies Department\" score=0.75"),
    ),
    (
        "African American Studies Program",
        (("Ethnic Studies", "crawl", "program"),),
        ("", "", "", "NO_MATCH", 0.0, "fuzzy_syn: rejected by strong_ref_gate filter cand=\"Ethnic Studies\" score=0.50"),
    ),
)

#: For each of the cells: reference, match (title, source, kind, level, score, detail), whether the reference names a unit, what was recombined, titles
#: found by the crawl, the third party, as signals, all of them, those that match in no mode, and programs beside a unit that matched.
DISCOVERED = (
    ("Africana Studies", "Africana Studies", "crawl", "program", "winner_override", 1.0, "winner_override: replaced=\"Africana Studies Black Studies Other\" (related_domain_backstop) -> \"Africana Studies\"; patch1:primary_academic | score=1.00", 0, "recombined_from_pipe: Africana Studies|Black Studies|Other => Africana Studies Black Studies Other, Africana Studies Black Studies", "Africana Studies Black Studies Other|Africana Studies Black Studies|Africana Studies|Black Studies|Other", "", "Center for Race|Ethnic Council", "Africana Studies Black Studies Other|Africana Studies Black Studies|Africana Studies|Black Studies|Other|Center for Race|Ethnic Council", "Africana Studies Black Studies|Black Studies|Other|Center for Race|Ethnic Council", ""),
    ("X", "", "", "", "NO_MATCH", 0.0, "", 0, "", "African, Black and Caribbean Studies|Music", "Ethnic, Cultural Minority, and Gender Studies, Other", "", "African, Black and Caribbean Studies|Music|Ethnic, Cultural Minority, and Gender Studies, Other", "African, Black and Caribbean Studies|Music|Ethnic, Cultural Minority, and Gender Studies, Other", ""),
    ("Y", "", "", "", "NO_MATCH", 0.0, "", 0, "recombined_from_pipe: Ethnic|Cultural Studies|Other => Ethnic Cultural Studies Other, Ethnic Cultural Studies", "Art|Music|Dance", "Ethnic Cultural Studies|Ethnic / Cultural Studies / Other", "", "Art|Music|Dance|Ethnic Cultural Studies|Ethnic / Cultural Studies / Other", "Art|Music|Dance|Ethnic Cultural Studies|Ethnic / Cultural Studies / Other", ""),
    ("Z", "", "", "", "NO_MATCH", 0.0, "", 0, "", "Department of Music", "", "Department of Music", "Department of Music", "Department of Music", ""),
    ("", "", "", "", "NO_MATCH", 0.0, "", 0, "", "", "", "", "", "", ""),
    ("W", "", "", "", "NO_MATCH", 0.0, "", 0, "", "a|b", "", "", "a|b", "a|b", ""),
)
