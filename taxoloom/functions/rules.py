"""Ordered rules: the first pattern that a folded label matches decides.

A rule list is data: (class, pattern) in the order in which they are tried.  ``first_match`` turns one into a single CASE
expression, so a label is classified inside the generated code of its stage.  The lists below are the defaults.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxoloom.functions.text import normalize_label

# The classification patterns and the codes of the functional domains.
FINE = (
    ("mobile_development", r"(\bandroid\b|\bios\b|ipados|kotlin|\bswiftui\b|\bswift\b|flutter|react native|xamarin|objective-?c|mobile app|mobile develop|mobile application|\bcordova\b|\bionic\b|jetpack compose|\bapk\b|play store|app store|application mobile)"),
    ("data_engineering", r"(apache spark|\bspark\b|hadoop|\bkafka\b|airflow|\betl\b|\belt\b|data pipeline|data warehouse|data lake|databricks|big data|bigdata|\bhive\b|\bflink\b|snowflake|redshift|\bdbt\b|data engineering|data ingestion|stream processing|entrepot de donnee|kinesis|\bflume\b|\bsqoop\b|\bnifi\b|apache beam|informatica)"),
    ("hardware_embedded", r"(embedded system|systeme embarque|\bfirmware\b|microcontroller|micro-controller|\bfpga\b|\bplc\b|integrated circuit|circuit board|electronic circuit|\belectronics\b|computer hardware|\bhardware\b|\bsensor\b|arduino|raspberry|semiconductor|soldering|robotic|\brtos\b|\bvhdl\b|verilog|\bcan bus\b|mechatronic|materiel informatique)"),
)
COARSE = (
    ("security", r"\b(secur|cyber|crypto|encryption|penetration|pentest|vulnerab|firewall|malware|forensic|rgpd|gdpr|iso 27|siem|owasp|wireshark|authentication|\biam\b|identity management|\bnmap\b|intrusion detection|\bids\b|\bips\b|identity and access|acces et.*identite)"),
    ("ai_ml", r"(machine learning|deep learning|neural network|artificial intelligence|apprentissage automatique|intelligence artificielle|\bnlp\b|computer vision|tensorflow|pytorch|data science|datascience|data mining|image recognition|evolutionary algorithm|generative ai|\bllm\b|reinforcement learning)"),
    ("emerging_tech", r"(internet of things|\biot\b|augmented reality|virtual reality|\bar/vr\b|\bvr\b headset|blockchain|distributed ledger|smart contract|quantum comput|metaverse|wearable|\bnft\b|tokeniz)"),
    ("data_databases", r"(database|data warehouse|base de donnee|\bsql\b|nosql|analytics|donnee|business intelligence|\bbdd\b|\bbi\b|datastage|oracle|mongodb|postgres|mysql|mariadb|\bdb2\b|matplotlib|seaborn|plotly|ggplot|bokeh|data visuali|\btableau\b|power bi|data model|data governance|data quality|data reporting|decisionnel)"),
    ("cloud_devops", r"(\bcloud\b|\baws\b|azure|\bgcp\b|docker|kubernetes|devops|ci/cd|jenkins|terraform|ansible|conteneur|serverless|microservice|continuous integration|continuous deployment|helm\b|openshift)"),
    ("web", r"(\bweb\b|html|\bcss\b|\bsass\b|\bless\b|javascript|typescript|react|angular|\bvue\b|node\.?js|django|flask|\bphp\b|frontend|backend|front-end|back-end|\bcms\b|drupal|wordpress|webpack|bootstrap|jquery|rest api|graphql)"),
    ("networks", r"(network|reseau|telecom|routing|\btcp\b|\blan\b|\bwan\b|cisco|\bvoip\b|fibre|switch|\bdns\b|protocol|\bvpn\b|load balanc|\bsd-wan\b|broadcast)"),
    ("programming_languages", r"\b(python|java|c\+\+|c#|\.net|ruby|perl|golang|rust|kotlin|swift|scala|matlab|bash|powershell|pascal|\bvyper\b|solidity|programming language|langage de programmation|programmation|algorithm|coding|software|logiciel|application|applicati|develop|api\b|sdk|framework|compil|debug|version control|\bgit\b|object-oriented|functional programming|design pattern|integrated development|\bide\b|\bscript\b|versioning|typescript|node\.?js)"),
    ("systems_infrastructure", r"(operating system|\blinux\b|unix|windows server|systeme d exploitation|\bserver\b|serveur|virtualiz|virtual machine|hypervisor|vmware|citrix|infrastructure|storage|stockage|backup|sauvegarde|datacenter|data center|active directory|sharepoint|terminal service|remote desktop|middleware|mainframe|\bsan\b|\bnas\b|disaster recovery|reprise.*sinistre|recovery system|systeme informatique|informatique industrielle|administration systeme)"),
    ("it_management", r"(project management|gestion de projet|governance|gouvernance|\bitil\b|it service|service desk|help desk|helpdesk|user support|strateg|budget|risk management|gestion des risques|portfolio|business analysis|compliance|stakeholder|service management|gestion des incident|incident management|veille (technolog|reglementaire)|support technique|demarche qualite)"),
    ("methodology", r"(\bagile\b|scrum|kanban|\blean\b|devsecops|methodolog|methode|\buml\b|test driven|\btdd\b|\bbdd test\b|waterfall|\bsafe\b framework)"),
)
SOFT = (
    ("soft_leadership", r"(leader|lead others|lead a|manage a team|mentor|coach|teach|instruct|train|persuas|negotiat|influence|delegat|networking|liais|build.*trust|stakeholder|motivat.*(team|other))"),
    ("soft_collaboration", r"(team|collaborat|cooperat|communicat|\bempath|listen|feedback|interpersonal|co-?worker|colleague|service orient|customer|assist|support.*(other|co)|address an audience|moderate|consideration|relationship|social skill|work.*with.*people)"),
    ("soft_learning", r"(curiosit|lifelong|willing.*learn|eager to learn|open.?mind|self.?develop|upskill|continuous learning)"),
    ("soft_cognitive", r"(creativ|critical think|analytical|analyse|systems think|system thinking|problem.solv|problem solving|reasoning|innovat|ideation|conceptual|decision|judgement|judgment)"),
    ("soft_self_management", r"(self.?aware|self.?control|self.?regulat|initiative|independ|motivat|responsib|accountab|commit|deadline|\btime\b|priorit|attention to detail|\bdetail|quality|stress|frustrat|resilien|adapt|flexib|agilit|persist|persever|conscientious|\bgrit\b|mindset|reliab|dependab|determination|discipline|proactiv|organi[sz])"),
)
ROLE_DOMAINS = (
    ("dom_data_ai", r"(data scien|machine learning|\bml\b|\bai\b|artificial intel|deep learning|data analyst|data engineer|analytics|business intelligence|\bbi\b developer|data governance)"),
    ("dom_data_ai", r"(database|\bdba\b)"),
    ("dom_security", r"(security|cyber|infosec|penetration|forensic)"),
    ("dom_networks", r"(network|telecom|\bvoip\b|broadcast|radio|audiovisual)"),
    ("dom_web_mobile", r"(mobile|android|\bios\b)"),
    ("dom_web_mobile", r"(\bweb\b|front.?end|multimedia|\bui\b|\bux\b|user interface)"),
    ("dom_infra_cloud", r"(embedded|firmware|hardware)"),
    ("dom_infra_cloud", r"(devops|\bcloud\b|site reliability|\bsre\b|system admin|systems admin|infrastructure|operations tech)"),
    ("dom_it_mgmt", r"(support|help desk|helpdesk|user support)"),
    ("dom_it_mgmt", r"(manager|officer|governance|head of|director|scrum master|project manag|product manag|business analyst)"),
    ("dom_software", r"(\btest\b|\bqa\b|quality assurance|tester)"),
    ("dom_software", r"(game|games develop)"),
    ("dom_software", r"(developer|programmer|software|systems analyst|analyst programmer)"),
)
CODE_DOMAINS = {
    "2511": "dom_software",
    "2512": "dom_software",
    "2514": "dom_software",
    "2519": "dom_software",
    "2513": "dom_web_mobile",
    "3514": "dom_web_mobile",
    "2521": "dom_data_ai",
    "2522": "dom_infra_cloud",
    "3511": "dom_infra_cloud",
    "2529": "dom_infra_cloud",
    "2523": "dom_networks",
    "3513": "dom_networks",
    "3521": "dom_networks",
    "3522": "dom_networks",
    "133": "dom_it_mgmt",
    "1330": "dom_it_mgmt",
    "3512": "dom_it_mgmt",
    "25": "dom_software",
    "35": "dom_infra_cloud",
}
# Category -> functional domain.
CATEGORY_DOMAINS = {
    "programming_languages": "dom_software", "methodology": "dom_software", "web": "dom_web_mobile", "mobile_development": "dom_web_mobile",
    "data_databases": "dom_data_ai", "data_engineering": "dom_data_ai", "ai_ml": "dom_data_ai", "systems_infrastructure": "dom_infra_cloud",
    "cloud_devops": "dom_infra_cloud", "hardware_embedded": "dom_infra_cloud", "networks": "dom_networks", "security": "dom_security",
    "it_management": "dom_it_mgmt", "emerging_tech": "dom_emerging", "knowledge_general": "dom_cross", "other_hard": "dom_cross",
    "soft_cognitive": "dom_soft", "soft_self_management": "dom_soft", "soft_collaboration": "dom_soft", "soft_leadership": "dom_soft",
    "soft_learning": "dom_soft", "soft_transversal": "dom_soft",
}


def first_match(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The class of the first rule whose pattern the text holds; null if none does."""
    picked = None
    for name, pattern in rules:
        hit = text.rlike(pattern)
        picked = F.when(hit, name) if picked is None else picked.when(hit, name)
    return picked


def category(label: Column | str, hard_soft: Column | str, kind: Column | str, own: Column | None = None) -> Column:
    """One category for a skill: soft rules for soft ones; else fine rules, its source's own valid class, coarse rules."""
    padded = F.concat(F.lit(" "), normalize_label(label), F.lit(" "))
    soft = F.coalesce(F.col(hard_soft) if isinstance(hard_soft, str) else hard_soft, F.lit("")) == "soft"
    knowledge = F.coalesce(F.col(kind) if isinstance(kind, str) else kind, F.lit("")) == "knowledge"
    rest = F.when(knowledge, "knowledge_general").otherwise("other_hard")
    valid = F.when(own.isin(*CATEGORY_DOMAINS), own) if own is not None else F.lit(None)
    return F.when(soft, F.coalesce(valid, first_match(padded, SOFT), F.lit("soft_transversal"))).otherwise(F.coalesce(first_match(padded, FINE), valid, first_match(padded, COARSE), rest))


def domain_of_category(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in CATEGORY_DOMAINS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, c), F.lit("dom_cross"))


def hard_soft_of(c: Column) -> Column:
    """hard or soft by category; null if the category is unknown."""
    return F.when(c.isin(*[k for k, d in CATEGORY_DOMAINS.items() if d == "dom_soft"]), "soft").when(c.isin(*CATEGORY_DOMAINS), "hard")


def role_domain(label: Column, code: Column | str) -> Column:
    """The functional domain of a role: by its label, else by its code, whole, three or two digits."""
    table = F.create_map(*[F.lit(x) for kv in CODE_DOMAINS.items() for x in kv])
    c = F.trim(F.coalesce(F.col(code) if isinstance(code, str) else code, F.lit("")))
    by_code = [F.try_element_at(table, k) for k in (c, F.substring(c, 1, 3), F.substring(c, 1, 2))]
    return F.coalesce(first_match(normalize_label(label), ROLE_DOMAINS), *by_code, F.lit("dom_cross"))
