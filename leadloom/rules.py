"""Fixed values of the rules: host lists, word lists, patterns, point tables.

Patterns are written for lower-cased text, with \\b for the boundary of an ASCII
word; ``functions.dialect`` turns them into what an engine understands.
"""

from __future__ import annotations

# ---- fixed values: hosts -------------------------------------------------

#: Hosts of platforms, portals and media that are never a company's own site, as they stand.
JUNK_HOSTS = """
scribd.com www.scribd.com reddit.com www.reddit.com old.reddit.com quora.com www.quora.com alibaba.com www.alibaba.com m.alibaba.com
aliexpress.com www.aliexpress.com 1688.com www.1688.com taobao.com www.taobao.com jd.com www.jd.com pinduoduo.com linkedin.com www.linkedin.com
facebook.com www.facebook.com m.facebook.com twitter.com www.twitter.com x.com instagram.com www.instagram.com youtube.com www.youtube.com
tiktok.com www.tiktok.com pinterest.com www.pinterest.com made-in-china.com www.made-in-china.com globalsources.com www.globalsources.com
tradeindia.com www.tradeindia.com tradekey.com www.tradekey.com exportersindia.com www.exportersindia.com ec21.com www.ec21.com
ecplaza.net www.ecplaza.net kompass.com www.kompass.com yellowpages.com www.yellowpages.com yelp.com www.yelp.com
amazon.com www.amazon.com amazon.co.uk amazon.de ebay.com www.ebay.com etsy.com www.etsy.com shopify.com www.shopify.com
tradesparq.com dungedon.com bing.com www.bing.com google.com www.google.com yahoo.com answers.yahoo.com wikipedia.org en.wikipedia.org wikidata.org
zaobao.com.sg www.zaobao.com.sg zaobao.sg straitstimes.com www.straitstimes.com channelnewsasia.com www.channelnewsasia.com
todayonline.com www.todayonline.com businesstimes.com.sg www.businesstimes.com.sg mothership.sg www.mothership.sg stomp.straitstimes.com stomp.com.sg
8world.com www.8world.com beritaharian.sg www.beritaharian.sg tamilmurasu.com.sg tnp.sg
thestar.com.my www.thestar.com.my nst.com.my www.nst.com.my malaymail.com www.malaymail.com sinchew.com.my www.sinchew.com.my
bbc.com www.bbc.com bbc.co.uk cnn.com www.cnn.com reuters.com www.reuters.com bloomberg.com www.bloomberg.com ft.com www.ft.com wsj.com www.wsj.com
theguardian.com www.theguardian.com techcrunch.com www.techcrunch.com forbes.com www.forbes.com businessinsider.com www.businessinsider.com
nytimes.com www.nytimes.com washingtonpost.com www.washingtonpost.com
""".split()
JUNK_HOST_PATTERN = r"scribd\.|1688\.com|wikip(e|é)dia|fandom\.com|blogspot\.|wordpress\.com|medium\.com|substack\.com"
SOCIAL_HOSTS = "facebook.com instagram.com linkedin.com x.com twitter.com youtube.com tiktok.com pinterest.com m.facebook.com".split()
AGGREGATOR_HOSTS = """
yellowpages.com yelp.com kompass.com tradeindia.com tradekey.com globalsources.com made-in-china.com ec21.com ecplaza.net bbb.org
globalimporter.net thomasnet.com manta.com dnb.com crunchbase.com
""".split()
NEWS_HOSTS = """
zaobao.com.sg www.zaobao.com.sg zaobao.sg zbschools.sg straitstimes.com www.straitstimes.com channelnewsasia.com www.channelnewsasia.com
todayonline.com www.todayonline.com businesstimes.com.sg www.businesstimes.com.sg mothership.sg www.mothership.sg stomp.straitstimes.com stomp.com.sg
8world.com www.8world.com beritaharian.sg www.beritaharian.sg tamilmurasu.com.sg tnp.sg
thestar.com.my www.thestar.com.my nst.com.my www.nst.com.my malaymail.com www.malaymail.com sinchew.com.my www.sinchew.com.my
bbc.com www.bbc.com bbc.co.uk cnn.com www.cnn.com reuters.com www.reuters.com bloomberg.com www.bloomberg.com ft.com www.ft.com wsj.com www.wsj.com
theguardian.com www.theguardian.com techcrunch.com www.techcrunch.com forbes.com www.forbes.com businessinsider.com www.businessinsider.com
nytimes.com www.nytimes.com washingtonpost.com www.washingtonpost.com
""".split()
NEWS_HOST_PATTERN = r"\.(news|press|media|journalist|tribune|gazette|herald|chronicle|times\.com\.sg|daily|weekly|post\.com)\z"
PLATFORM_HOSTS = """
alibaba.com aliexpress.com amazon.com thomasnet.com globalsources.com made-in-china.com tradeindia.com indiamart.com tradewheel.com ec21.com
ecplaza.net tradekey.com go4worldbusiness.com reddit.com quora.com wikipedia.org wikihow.com youtube.com facebook.com instagram.com
linkedin.com x.com twitter.com tiktok.com
""".split()
#: Import directories: a hit there is evidence, not a company's site.
SIGNAL_SOURCE_HOSTS = "importyeti.com volza.com panjiva.com".split()
JUNK_CONTENT_HOST_PATTERN = r"\b(seair\.co\.in|importinfo\.com|importyeti\.com|volza\.com|panjiva\.com|trademo\.com|usetorg\.com|indexbox\.io|govtrack\.us|zoom\.us|example\.com|wixpress\.com|sentry-next|freepik|shutterstock|carousell\.com|globalspec\.com|highergov\.com|rxglobal\.com|customs\.gov\.sg|google\.com|play\.google|thesmartlocal\.com|amcham\.com\.sg|mothership\.sg)\b"

# ---- fixed values: e-mail ------------------------------------------------

NON_BUYER_EMAIL_HOSTS = """
bebee.com rocketreach.co zoominfo.com apollo.io leadiq.com lusha.com culinaryagents.com indeed.com glassdoor.com monster.com
seafoodsource.com perishablepundit.com newsbywire.com rfmaonline.com aroq.com metispartners.com expanamarkets.com foodbev.com
foodprocessing.com fooddive.com sec.gov hmrc.gov.uk spglobal.com moodys.com fitchratings.com ftc.gov interodigital.com marketinggenie.io
spa-terminus.co.uk jandmgroup.co.uk kalidirectory.com alamy.com bbb.org yellowpages.com yelp.com scribd.com issuu.com slideshare.net
""".split()
FREE_EMAIL_HOSTS = """
gmail.com googlemail.com outlook.com hotmail.com live.com msn.com yahoo.com yahoo.co.uk yahoo.co.jp 163.com 126.com qq.com sina.com
foxmail.com icloud.com me.com mac.com aol.com protonmail.com proton.me zoho.com yandex.com yandex.ru mail.ru
""".split()
PLACEHOLDER_LOCALS = """
test example demo sample dummy noreply no-reply donotreply do-not-reply donotresponse jane.doe john.doe john.smith jane.smith first.last
firstname.lastname email user name your yourname you me myname admin root test123 abc
""".split()
PLACEHOLDER_EMAILS = """
email@address.com test@test.com your@email.com name@email.com user@example.com example@example.com info@info.com contact@contact.com
""".split()
PLACEHOLDER_PATTERN = r"\bexample\b|\byour-?(?:name|email)\b|\bplace.?holder\b|\b(first|last).?(?:name|n)\b"
PR_PREFIXES = """
press media investor investorrelations investor-relations ir pressroom newsroom communications publicaffairs chairman ceo ceopanel
sustainability esg csr compliance audit regulatory legal membership secretary secretariat exec.director exec-director
""".split()
SECOND_LEVEL_SUFFIXES = """
co.uk co.jp co.kr co.nz co.za co.in com.au com.cn com.hk com.tw com.sg com.my com.br com.mx com.tr com.ar net.au net.cn net.uk org.uk
org.au org.cn gov.uk gov.cn gov.au ac.uk ac.jp edu.au edu.cn
""".split()
NOISE_EMAIL_PATTERN = r"^(user@example\.com|user@domain\.com|info@domain\.com|xxx@organisation\.com|noreply@|no-reply@|orga@|group@thesmartlocal)|copyright|@organisation\.com\z|sales@.+\.sgcopyright"

# ---- fixed values: countries ---------------------------------------------

COUNTRY_HINTS = {
    "US": ["united states", "usa", "america", "美国"], "CN": ["china", "prc", "chinese", "中国"], "SG": ["singapore", "新加坡"], "MY": ["malaysia", "马来西亚"],
    "TH": ["thailand", "泰国"], "VN": ["vietnam", "越南"], "ID": ["indonesia", "印尼", "印度尼西亚"], "PH": ["philippines", "菲律宾"], "JP": ["japan", "日本"],
    "KR": ["south korea", "korea", "韩国"], "GB": ["united kingdom", "uk", "britain", "英国"], "DE": ["germany", "德国"], "FR": ["france", "法国"], "IT": ["italy", "意大利"],
    "ES": ["spain", "西班牙"], "CA": ["canada", "加拿大"], "AU": ["australia", "澳大利亚", "澳洲"], "CH": ["switzerland", "swiss", "瑞士"], "BR": ["brazil", "巴西"],
    "IN": ["india", "印度"], "TR": ["turkey", "土耳其"], "AE": ["uae", "united arab emirates", "阿联酋"], "SA": ["saudi arabia", "沙特"],
}
CCTLDS = {
    "us": "US", "cn": "CN", "sg": "SG", "my": "MY", "th": "TH", "vn": "VN", "id": "ID", "ph": "PH",
    "jp": "JP", "kr": "KR", "uk": "GB", "gb": "GB", "de": "DE", "fr": "FR", "it": "IT", "es": "ES",
    "ca": "CA", "au": "AU", "ch": "CH", "br": "BR", "in": "IN", "tr": "TR", "ae": "AE", "sa": "SA",
}
CALLING_CODES = {
    "1": "US", "86": "CN", "65": "SG", "60": "MY", "66": "TH", "84": "VN", "62": "ID", "63": "PH", "81": "JP", "82": "KR", "44": "GB", "49": "DE", "33": "FR", "39": "IT",
    "34": "ES", "61": "AU", "41": "CH", "55": "BR", "91": "IN", "90": "TR", "971": "AE", "966": "SA",
}
GEO_NAMES = r"新加坡|韩国|中国|美国|英国|德国|法国|澳洲|澳大利亚|马来西亚|泰国|越南|印尼|印度尼西亚|菲律宾|印度|台湾|香港|澳门|singapore|korea|china|usa|united\s+states|uk|united\s+kingdom|germany|france|australia|malaysia|thailand|vietnam|indonesia|philippines|india|taiwan|hong\s+kong"
GEO_CODES = "sg|us|uk|jp|cn|my|th|vn|id|in|kr|tw|hk|de|fr|au|ph"
COLLOQUIAL = "有没有|有冇|有木有|哪里有|哪儿有|求购|想买|帮我找|帮我搜|搜索|查询|请问|我想找|我要找|谁有|谁卖|谁进口"

# ---- fixed values: names and kinds of entity -----------------------------

JUNK_NAMES = ["n/a", "na", "unknown", "none", "null", "test", "demo", "sample", "example", "—", "-", "company"]
LEGAL_SUFFIX_PATTERN = r"[\s,\.\-]*(ltd\.?|limited|llc\.?|l\.l\.c\.?|inc\.?|incorporated|corp\.?|corporation|co\.?|company|gmbh|s\.a\.?|b\.v\.?|pty\.?|plc\.?|sdn\.? bhd\.?|pvt\.? ltd\.?|joint stock|j\.s\.c|as|aps|ab|oy|nv|kk|ag)\.?\s*\z"
NEWS_TEXT_PATTERN = r"\b(news|press|journal|报道|新闻|专访|记者|通讯社)\b"
SOCIAL_TEXT_PATTERN = r"\b(facebook|instagram|linkedin|x\.com|twitter|youtube|tiktok|social)\b"
ASSOCIATION_NAME_PATTERN = r"\b(association|associations|federation|federation\s+of|society|societies|chamber\s+of\s+commerce|board\s+of\s+trade|trade\s+body|industry\s+body|member(?:ship)?\s+organization|membership\s+org(?:anization)?)\b"
ASSOCIATION_MAYBE_PATTERN = r"\b(council|institute|guild|consortium|coalition|alliance|committee|bureau|authority|board\s+of\s+trade)\b"
ASSOCIATION_TEXT_PATTERN = r"\b(trade\s+association|industry\s+association|industry\s+group|trade\s+group|professional\s+association|membership\s+organization|member(?:ship)?\s+body|advocacy\s+group|industry\s+council|trade\s+council|non-?profit\s+trade\s+org|nonprofit\s+industry)\b"
ASSOCIATION_LOCALS = ["membership", "member", "secretary", "secretariat", "exec.director", "executive.director", "exec-director"]
SELLER_TEXT_PATTERN = r"\b(we\s+(?:manufacture|produce|fabricate)\b|we\s+are\s+(?:a\s+)?(?:leading\s+)?(?:manufacturer|producer|fabricator)\b|(?:established|founded)\s+(?:in\s+)?\d{4}[,\s]+(?:to\s+)?manufactur\w*|our\s+(?:manufacturing\s+plant|production\s+facility|production\s+line|production\s+base))\b"
SELLER_NAME_PATTERN = r"\b(manufacturer|manufacturers|manufacturing|factory|factories|producer|producers|fabricator|fabricators|mill\b|mills\b)\b"
LOGISTICS_PATTERN = r"\b(freight\s+forwarder(?:ing)?|customs\s+broker(?:age)?|third.?party\s+logistics|3pl\b|cargo\s+agent|shipping\s+agent)\b"
INFO_SERVICE_PATTERN = r"\b(market\s+research\s+(?:firm|company|group|agency)|industry\s+(?:analyst|analytics)\s+(?:firm|company)|market\s+intelligence\s+(?:firm|company|group))\b"
SUPPLIER_PATTERN = r"\b(manufacturer|manufactur|factory|factories|exporter|producer|supplier|fabricat|oem|odm|制造|工厂|出口商|生产商|供应商)\b"
CATEGORY_STOP_WORDS = "and the of for in at to a an with by from or its etc made used use type types grade grades".split()
CLOSED_PATTERN = r"(permanently\s+clos\w*|closed\s+down|ceased\s+operat\w*|no\s+longer\s+operat\w*|out\s+of\s+business|went\s+bankrupt|liquidat\w*|already\s+clos\w*|has\s+clos\w*|have\s+clos\w*|已结业|已停业|停止营业|结业清货|倒闭|停办|已停止营业|停业了|不再营业)"
#: Kinds of business that don't buy, unless the category makes them buyers.
BUSINESS_GROUPS = {
    "fastfood_chain": r"\b(mcdonald|kfc|starbucks|subway|burger.king|pizza.hut|domino|wendy|taco.bell)\b",
    "food_service": r"\b(restaurant|cafe|coffee\s+shop|fast[_\s]food|food.chain|bistro|bakery|eatery|diner)\b",
    "hospitality": r"\b(hotel|motel|hostel|inn\b|resort|lodge|accommodation)\b",
    "healthcare": r"\b(hospital|clinic|dental|medical.center|pharmacy|dispensary|healthcare.provider)\b",
    "education": r"\b(primary.school|secondary.school|university|college|academy\b|kindergarten|tuition)\b",
    "finance_legal": r"\b(bank\b|insurance\s+company|financial\s+service|accounting\s+firm|law\s+firm)\b",
    "government": r"\b(government|municipality|ministry|prefecture|public\s+sector|city.council|town.hall)\b",
    "nonprofit": r"\b(charity|ngo\b|nonprofit|non-profit|foundation\b)\b",
    "beauty_fitness": r"\b(salon|barbershop|spa\b|beauty.center|nail.studio|massage.parlor|gym\b|fitness.center)\b",
}
#: (pattern of a category, groups that buy in it)
CATEGORY_BUYERS = [
    (r"(\bflour\b|\bbread\b|\bpastry\b|\bbaking\b|bakery.ingredient|food.ingredient|\bspice\b|\bseasoning\b|\bsauce\b|\bcondiment\b|\bdairy\b|烘焙|面粉|面包|糕点|食材|食品配料|调料|乳制品)", ["food_service", "fastfood_chain", "hospitality"]),
    (r"(\bseafood\b|\bmeat\b|\bpoultry\b|\bbeef\b|\bpork\b|\bchicken\b|\bfish\b|\bvegetable\b|\bfruit\b|\bproduce\b|\bgrain\b|\brice\b|海鲜|肉类|蔬菜|水果|农产品|生鲜|大米|稻米)", ["food_service", "fastfood_chain", "hospitality"]),
    (r"(coffee.bean|coffee.roast|\btea\b|\bbeverage\b|\bdrink\b|\bjuice\b|\bwater\b|咖啡豆|茶叶|饮品|饮料|矿泉水)", ["food_service", "fastfood_chain", "hospitality"]),
    (r"(\bcosmetic\b|\bskincare\b|skin.care|beauty.product|\bhaircare\b|hair.care|nail.polish|essential.oil|\bperfume\b|\bfragrance\b|化妆品|美容|护肤|香精|精油|香水|彩妆|美甲)", ["beauty_fitness"]),
    (r"(medical.device|medical.equipment|medical.supply|medical.consumable|\bpharmaceutical\b|pharma.ingredient|api\b|\bdrug\b|dental.supply|dental.equipment|hospital.supply|surgical|医疗器械|医疗设备|医用耗材|药品|医药|牙科|手术|诊所设备)", ["healthcare"]),
    (r"(school.supply|\bclassroom\b|education.equipment|\btextbook\b|teaching.aid|教学设备|课桌|教材|文具|学习用品|学校设备|教学仪器)", ["education"]),
    (r"(hotel.supply|\bamenity\b|amenities|\btowel\b|\blinen\b|hospitality.supply|\bhousekeeping\b|\bmattress\b|guest.room|酒店用品|客房用品|布草|一次性用品|床品|客房备品|酒店家具)", ["hospitality"]),
    (r"(gym.equipment|fitness.equipment|\btreadmill\b|\bdumbbell\b|\bbarbell\b|exercise.machine|sports.equipment|健身器材|运动器材|健身房设备)", ["beauty_fitness"]),
    (r"(office.supply|\bstationery\b|\btoner\b|\bcartridge\b|copier.paper|file.cabinet|文具|办公用品|纸张|耗材|办公耗材|打印纸)", ["finance_legal", "education", "government", "nonprofit"]),
    (r"(banking.software|\bfintech\b|accounting.software|legal.tech|律所软件|银行系统|金融科技|金融软件|法务系统)", ["finance_legal"]),
    (r"(government.procurement|public.tender|公共采购|政府采购|公务用品|政务系统)", ["government"]),
    (r"(charity.supply|disaster.relief|humanitarian.aid|慈善物资|救灾物资|人道援助)", ["nonprofit"]),
]
#: Per family of trades: (pattern of a category, pattern of a lead's text)
FAMILIES = {
    "produce_food": (r"白菜|草莓|蔬菜|水果|海鲜|水产|大米|面粉|食品|蔬果|榴莲|土豆|马铃薯|肉|禽|蛋|奶|茶|酒|饮料|粮油|调味|\b(cabbage|strawberry|seafood|vegetable|fruit|produce|food|rice|flour|durian|potato|meat|poultry|dairy|beverage|grocery|fresh\s+produce)\b", r"\b(vegetable|fruit|produce|seafood|food\s+(supply|wholesale|trading|import)|wet\s+market|grocery|bok\s+choy|cabbage|strawberry)\b|蔬|果|海鲜|水产|白菜|草莓|粮油|食品批发|食品供应"),
    "auto": (r"汽车|汽配|车用|整车|轮胎|motoring|\b(auto(?:motive)?|car\s+parts?|vehicle\s+parts?|tyre|tire|motoring)\b", r"\b(car\s+enthusiast|thecarenthusiast|auto\s+parts?|motoring\s+news|automotive\s+parts?|car\s+dealer)\b"),
    "skincare_beauty": (r"护肤|化妆品|美容|彩妆|面膜|\b(skincare|skin\s*care|cosmetic|beauty|makeup|dermal)\b", r"\b(skincare|skin\s*care|cosmetic|odm\s+skincare|dermalab|beauty\s+manufacturer)\b"),
    "pharma": (r"药|制药|医药|保健品|原料药|\b(pharma(?:ceutical)?|api\b|supplement|nutraceutical|drug)\b", r"\b(pharmaceutical\s+contract\s+manufactur\w*|api\/?\s*supplements?|nutraceutical|pharma\s+oem)\b"),
    "electronics": (r"电视|电子|电器|芯片|半导体|手机|电脑|显示|\b(tv|television|electronics?|semiconductor|chip|smartphone|computer|display|led\s+lighting)\b", r"\b(electronics?\s+(oem|odm|contract)|semiconductor|pcb\s+assembl)\b"),
    "industrial_oem": (r"代工|合同制造|oem|odm|零部件|\b(contract\s+manufactur|oem|odm|precision\s+parts)\b", r"\b(contract\s+manufacturing|oem\/odm|odm\s+services)\b"),
}

# ---- fixed values: prefilter and hard noise ------------------------------

LISTICLE_PATTERN = r"\b(top\s*\d+|best\s+\w+|how\s+to\b|guide\s+to\b|review[s]?:?\b|vs\.?\b|things\s+you\s+should|^\d+\s+(best|top)|rankings?\b|jun\s+20\d{2}\s+rankings?|minimum\s+\d+\s*kg|起订)\b"
DIRECTORY_PATTERN = r"\b(membership\s+directory|list\s+of\s+companies|company\s+directory|industry\s+directory|chamber\s+of\s+commerce|amcham\b|content\s+creator\s+interview|questions\s+with\b|interview\s+with\b|top\s+manufacturing\s+companies|manufacturing\s+companies\s+in\s+\w+\s*-\s*(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)?\s*20\d{2}\s*rankings?)\b|会员名录|企业名录|商会名录|专访|访谈"
NEWS_TITLE_PATTERN = r"\b(breaking\s+news|press\s+release|media\s+release|news\s+report|daily\s+news|weekly\s+news|记者|报道|报章|新闻|报导|早报|联合早报|副刊|采访|专访|通讯社|smart\s*local|mothership)\b"
#: The prefilter's own rule; its stems end at a word's end, so "closed" alone is left to the gate.
CLOSED_STEM_PATTERN = r"\b(permanently\s+clos|closed\s+down|ceased\s+operat|no\s+longer\s+operat|out\s+of\s+business|went\s+bankrupt|liquidat|已结业|已停业|停止营业|结业清货|倒闭|停办)\b"
CN_HINT_PATTERN = r"\b(china|chinese|guangzhou|shenzhen|yiwu|shanghai|ningbo|hk\b|hong\s*kong)\b"
CN_ROLE_PATTERN = r"\b(supplier|exporter|manufacturer|factory)\b"
HARD_NOISE_PATTERN = r"\b(membership\s+directory|list\s+of\s+companies|company\s+directory|chamber\s+of\s+commerce|amcham\b|content\s+creator\s+interview|questions\s+with\b|interview\s+with\b|top\s+manufacturing\s+companies|manufacturing\s+companies\s+in\b[^-]*rankings?|20\s+questions\s+with)\b|会员名录|企业名录|商会名录|专访|访谈"
JUNK_TITLE_PATTERN = r"\[?\s*pdf\s*\]?|glossary|guidelines?\b|shipping policy|terms of sale|citizen petition|api\s*docs?|developer docs|importing into the|country requirements|trade facilitation act|comprehensive overview|market size|cagr of|job(s)?\b|vacancies|work from home|wikipedia|how to\b|what is\b|meaning of\b|highest paying|trade mission|rfp\b|visitor registration|apps on google play|online electronic store|industry directory|contract manufacturing services providers|rankings?\b|jun\s+20\d{2}|minimum\s+\d+\s*kg|起订"
PLATFORM_TITLE_PATTERN = r"\b(carousell|facebook|linkedin|google play|youtube|trade show|trade fair|forum\s*&\s*market|exhibition|expo\b|itb\b|atf\b|switch trade|medical\s+fair)\b|海关|singapore customs|customs\.gov|贸易展|展会"
SHELF_PATTERN = r"\b(market\s+fresh\s+pork|bok\s+choy\s+\d|\/pkt\b|add\s+to\s+cart)\b"
OEM_PATTERN = r"\b(contract manufacturing|odm services|oem\b|factory outlet)\b"
INTENT_POINTS = {"USER_SEED_INLINE": 35, "USER_SEED": 32, "BOL_SIGNAL": 28, "CUSTOMS_SIGNAL": 28, "CUSTOMS_DB": 26, "IMPORT_RECORD": 24, "PROCUREMENT_DECISION_MAKER": 22, "PRIVATE_LABEL": 18, "B2B_BUYER": 16, "PILLAR0_BOOLEAN": 14}
MATCH_POINTS = {"high": 40, "medium": 22, "low": 8, "none": 0}
#: (pattern of the pillar, points), the first that matches
PILLAR_POINTS = [(r"pillar\s*0|seed", 30), (r"pillar\s*10|verifiedsource", 22), (r"pillar\s*7|customs", 18), (r"pillar\s*11|linkedin", 16), (r"pillar\s*8|b2b", 12)]
#: (pattern of the pillar, how the lead was found)
PILLAR_VIA = [
    (r"pillar 1 lbs|maps", "maps"), (r"pillar yellow", "yellowpages"), (r"pillar fb public", "facebook_public"), (r"pillar 11 linkedin", "linkedin_snippet"), (r"pillar yt about", "youtube_about"),
    (r"pillar x public", "x_public"), (r"pillar tg public", "telegram_public"), (r"pillar 0 seed", "seed"), (r"pillar 9 lookalike", "lookalike"), (r"pillar s madeinchina", "made_in_china"),
    (r"pillar s globalsources", "global_sources"), (r"pillar s thomasnet", "thomasnet"), (r"pillar s alibaba", "alibaba_intl"), (r"pillar s factory|pillar s exporter", "supplier_direct"),
]
ROLE_BUSINESS = {
    "importer": "importer", "import company": "importer", "trading company": "wholesaler", "trader": "wholesaler", "wholesaler": "wholesaler", "wholesale": "wholesaler", "retailer": "retailer", "retail": "retailer",
    "distributor": "distributor", "distribution": "distributor", "manufacturer": "manufacturer", "factory": "manufacturer", "service provider": "service", "service": "service", "buyer": "importer",
}
CYCLES = {
    "week": "weekly", "weekly": "weekly", "bi-weekly": "monthly", "biweekly": "monthly", "fortnightly": "monthly", "month": "monthly", "monthly": "monthly", "quarter": "quarterly", "quarterly": "quarterly",
    "qtr": "quarterly", "semi-annual": "quarterly", "semiannual": "quarterly", "biannual": "quarterly", "half-yearly": "quarterly", "year": "annual", "yearly": "annual", "annual": "annual", "annually": "annual",
}
#: Contact sources: confidence of a channel, and priority in a list.
SOURCE_CONFIDENCE = {"mailto_link": 0.95, "tel_link": 0.95, "whatsapp_link": 0.9, "plain_regex": 0.5, "deobfuscated": 0.55}
SOURCE_PRIORITY = {"mailto_link": 100, "tel_link": 100, "whatsapp_link": 90, "plain_regex": 50, "deobfuscated": 30}
CONTACT_WORDS_PATTERN = r"(contact|get[\s\-]?in[\s\-]?touch|reach[\s\-]?us|inquiry|enquiry|联系|联络|聯絡|お問い合わせ|문의|kontakt|contacto|contato)"
CONTACT_PATHS = "/contact /contact/ /contact-us /contact-us/ /contact.html /about /about-us /get-in-touch /reach-us /inquiry /zh/contact /en/contact".split()
PROFILE_HOSTS = "facebook.com m.facebook.com instagram.com linkedin.com youtube.com m.youtube.com twitter.com x.com".split()
PROFILE_BANNED_PATTERN = r"^/sharer|^/login|^/dialog|^/intent|^/share|^/help|^/policies?|^/groups/.+/(posts|permalink|members)"
PROFILE_PATH_PATTERN = r"^/[^/?#]+/?\z|^/company/[^/?#]+/?\z|^/in/[^/?#]+/?\z|^/c/[^/?#]+/?\z|^/@[^/?#]+/?\z|^/groups/[^/?#]+/?\z"
RESERVED_SEGMENTS = "i home search explore intent share sharer sharer.php plugins dialog tr p reel reels stories hashtag about watch events groups pages login signup messages".split()
#: Tax numbers per country: pattern with the number in group 1, and whether only its digits are kept.
TAX_ID_PATTERNS = {"br": (r"\b(\d{2}[.\s]?\d{3}[.\s]?\d{3}[/\s]?\d{4}[-\s]?\d{2})\b", True), "pe": (r"\bruc[:\s]+(\d{11})\b", False), "co": (r"\bnit[:\s]+([\d-]+)", True), "cl": (r"\brut[:\s]+([\d.\-k]+)", False), "ar": (r"\bcuit[:\s]+(\d{11})\b", False)}
EMAIL_BLOCKED = "example yourdomain @domain. @email. noreply no-reply donotreply sentry.io wixpress.com".split()
FREE_EMAIL_LAST = "gmail.com yahoo.com yahoo.co.uk hotmail.com outlook.com qq.com 163.com".split()

# ---- fixed values: links and raw signals ---------------------------------

INTAKE_SOCIAL_PATTERN = r"(facebook|instagram|linkedin|twitter|x\.com|youtube|tiktok|pinterest)\."
INTAKE_AGGREGATOR_PATTERN = r"(yellowpages|yelp|kompass|tradeindia|tradekey|ec21|ecplaza)\."
INTAKE_NEWS_PATTERN = r"\b(news|press|journal|报道|新闻|记者|通讯社)\b"
#: Schemes of links, and channel|confidence.
SCHEME_CHANNELS = {"^skype:.": "skype|0.7", "^viber:": "viber|0.7", "^weixin:": "wechat|0.6", "^line:": "line|0.7", "^tg:": "telegram|0.7"}
#: Hosts whose every link is a channel.
CHANNEL_HOSTS = """wa.me api.whatsapp.com whatsapp.com t.me telegram.me telegram.org line.me lin.ee instagram.com linkedin.com twitter.com x.com facebook.com fb.com fb.me m.facebook.com messenger.com youtube.com
youtu.be tiktok.com skype.com join.skype.com weixin.qq.com kakao.com open.kakao.com zalo.me viber.com signal.me""".split()
HOST_CHANNELS = {"line.me": "line|0.8", "lin.ee": "line|0.8", "messenger.com": "messenger|0.7", "m.me": "messenger|0.7", "join.skype.com": "skype|0.65", "skype.com": "skype|0.65", "weixin.qq.com": "wechat|0.55", "kakao.com": "kakao|0.7", "open.kakao.com": "kakao|0.7", "zalo.me": "zalo|0.7", "signal.me": "signal|0.7"}

# ---- fixed values: platforms and pillars ---------------------------------

PLATFORMS = "maps yellowpages facebook_public linkedin_snippet youtube_about x_public telegram_public".split()
SUPPLIER_PLATFORMS = "made_in_china global_sources thomasnet kompass alibaba_intl 1688 tmall gov_registry industry_association jd_b2b serper customs".split()
BUYER_PILLARS = """p0_seed p_pillar0_boolean p_procurement p1_maps_dist p1_maps_trading p1_maps_personas p2_direct_importer p2_sourcing_intent p3_jobs_procurement p3_jobs_buyer p4_rfq p4_sourcing_post p5_tenders p6_buyer_assoc p6_trade_show_buyer
p7_customs_direct p7_customs_signal_source p7_bol_signal p8_b2b_buyer p8_ecommerce_import p10_verified_sources p11_linkedin_decision p_yellowpages p_facebook_public p_youtube_about p_x_public p_telegram_public p9_lookalike""".split()
SUPPLIER_PILLARS = "s_made_in_china s_global_sources s_thomasnet s_alibaba s_factory_direct s_exporter".split()
SHARED_PILLARS = ["p0_seed", "p_pillar0_boolean"]
LOW_WEIGHT = 0.35
PILLARS_BY_WEIGHT = {
    "generic": """p2_direct_importer p2_sourcing_intent p3_jobs_procurement p3_jobs_buyer p4_rfq p4_sourcing_post p5_tenders p6_buyer_assoc p6_trade_show_buyer p7_customs_direct p7_customs_signal_source p7_bol_signal
    p8_b2b_buyer p8_ecommerce_import p10_verified_sources p9_lookalike""".split(),
    "geo": ["p1_maps_dist", "p1_maps_trading", "p1_maps_personas"],
    "contact": ["p_yellowpages"],
}
PILLARS_BY_PLATFORM = {
    "maps": ["p1_maps_dist", "p1_maps_trading", "p1_maps_personas"], "yellowpages": ["p_yellowpages"], "facebook_public": ["p_facebook_public"], "linkedin_snippet": ["p11_linkedin_decision"], "youtube_about": ["p_youtube_about"], "x_public": ["p_x_public"],
    "telegram_public": ["p_telegram_public"],
}

# ---- fixed values: categories, places and languages by code --------------

#: A country's name at the start of a category text.
COUNTRY_PREFIX_PATTERN = r"(?i)^(?:印尼|印度尼西亚|印度|越南|泰国|马来西亚|新加坡|菲律宾|缅甸|柬埔寨|老挝|韩国|日本|中国|美国|英国|德国|法国|意大利|西班牙|葡萄牙|荷兰|比利时|波兰|俄罗斯|加拿大|墨西哥|巴西|阿根廷|智利|秘鲁|哥伦比亚|沙特|阿联酋|土耳其|埃及|肯尼亚|尼日利亚|南非|澳大利亚|新西兰|indonesia|india|vietnam|thailand|malaysia|singapore|philippines|myanmar|cambodia|laos|korea|japan|china|usa|us|uk|gb|germany|france|italy|spain|portugal|netherlands|belgium|poland|russia|canada|mexico|brazil|argentina|chile|peru|colombia|saudi|uae|turkey|egypt|kenya|nigeria|south africa|australia|new zealand)\s*[的,，]?\s*"
#: Kinds of place that don't buy a category, and those for all others.
PLACE_BLACKLISTS = {
    "food": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "garlic": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "ginger": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "seafood": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "fruit": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "vegetable": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "spice": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "grain": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "rice": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "beverage": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "dairy": "bank insurance_agency lawyer accounting real_estate_agency car_dealer".split(),
    "pharma_medical": "bank insurance_agency lawyer accounting car_dealer travel_agency restaurant".split(),
    "pharma_health": "bank insurance_agency lawyer accounting car_dealer travel_agency restaurant".split(),
    "electronic_components": "bank insurance_agency lawyer accounting real_estate_agency".split(),
    "semiconductor": "bank insurance_agency lawyer accounting real_estate_agency".split(),
    "machinery_equipment": "bank insurance_agency lawyer accounting real_estate_agency".split(),
    "laser_photonics": "bank insurance_agency lawyer accounting real_estate_agency".split(),
    "laser_equipment": "bank insurance_agency lawyer accounting real_estate_agency".split(),
    "metal_steel_raw": "bank insurance_agency lawyer accounting".split(),
    "chemical_plastic_raw": "bank insurance_agency lawyer accounting".split(),
    "auto_parts_tire": "bank lawyer accounting restaurant cafe".split(),
    "new_energy": "bank insurance_agency lawyer accounting restaurant".split(),
    "battery_energy_storage": "bank insurance_agency lawyer accounting restaurant".split(),
    "photovoltaic_solar": "bank insurance_agency lawyer accounting restaurant".split(),
}
PLACE_BLACKLIST_DEFAULT = "bank lawyer accounting insurance_agency real_estate_agency".split()
COUNTRY_NAMES = {
    "vn": "Vietnam", "th": "Thailand", "id": "Indonesia", "my": "Malaysia", "sg": "Singapore", "ph": "Philippines", "mm": "Myanmar", "kh": "Cambodia", "bd": "Bangladesh", "pk": "Pakistan",
    "in": "India", "lk": "Sri Lanka", "np": "Nepal", "jp": "Japan", "kr": "South Korea", "tw": "Taiwan", "cn": "China", "hk": "Hong Kong", "mo": "Macau", "ru": "Russia",
    "ae": "UAE", "sa": "Saudi Arabia", "qa": "Qatar", "kw": "Kuwait", "bh": "Bahrain", "om": "Oman", "tr": "Turkey", "il": "Israel", "jo": "Jordan", "eg": "Egypt",
    "us": "United States", "mx": "Mexico", "br": "Brazil", "co": "Colombia", "cl": "Chile", "pe": "Peru", "ar": "Argentina", "ca": "Canada",
    "de": "Germany", "gb": "United Kingdom", "fr": "France", "it": "Italy", "es": "Spain", "nl": "Netherlands", "pl": "Poland", "se": "Sweden", "no": "Norway", "dk": "Denmark",
    "pt": "Portugal", "ie": "Ireland", "ch": "Switzerland", "at": "Austria", "be": "Belgium", "fi": "Finland", "cz": "Czech Republic", "hu": "Hungary", "ro": "Romania", "bg": "Bulgaria",
    "sk": "Slovakia", "hr": "Croatia", "si": "Slovenia", "ee": "Estonia", "lv": "Latvia", "lt": "Lithuania", "lu": "Luxembourg", "is": "Iceland", "mt": "Malta", "cy": "Cyprus",
    "ng": "Nigeria", "za": "South Africa", "ke": "Kenya", "gh": "Ghana", "et": "Ethiopia", "au": "Australia", "nz": "New Zealand",
}
#: English where a code has none.
LANGUAGES = {
    "vn": "Vietnamese", "th": "Thai", "id": "Indonesian", "my": "Malay", "ph": "Filipino", "mm": "Burmese", "kh": "Khmer", "bd": "Bengali", "pk": "Urdu", "in": "Hindi", "lk": "Sinhala",
    "jp": "Japanese", "kr": "Korean", "tw": "Traditional Chinese", "cn": "Simplified Chinese", "hk": "Traditional Chinese", "mo": "Traditional Chinese", "ru": "Russian",
    "ae": "Arabic", "sa": "Arabic", "qa": "Arabic", "kw": "Arabic", "bh": "Arabic", "om": "Arabic", "tr": "Turkish", "il": "Hebrew", "jo": "Arabic", "eg": "Arabic",
    "mx": "Spanish", "co": "Spanish", "cl": "Spanish", "pe": "Spanish", "ar": "Spanish", "br": "Portuguese", "de": "German", "fr": "French", "it": "Italian", "es": "Spanish", "nl": "Dutch",
    "pl": "Polish", "se": "Swedish", "no": "Norwegian", "dk": "Danish", "pt": "Portuguese", "ch": "German", "at": "German", "be": "Dutch", "fi": "Finnish", "cz": "Czech", "hu": "Hungarian",
    "ro": "Romanian", "bg": "Bulgarian", "sk": "Slovak", "hr": "Croatian", "si": "Slovenian", "ee": "Estonian", "lv": "Latvian", "lt": "Lithuanian", "lu": "French", "is": "Icelandic",
    "cy": "Greek", "et": "Amharic",
}
MAJOR_CITIES = {
    "US": ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix"], "GB": ["London", "Birmingham", "Manchester", "Leeds", "Bristol"], "DE": ["Berlin", "Hamburg", "Munich", "Frankfurt", "Cologne"],
    "FR": ["Paris", "Lyon", "Marseille", "Toulouse", "Bordeaux"], "JP": ["Tokyo", "Osaka", "Nagoya", "Sapporo", "Fukuoka"], "KR": ["Seoul", "Busan", "Incheon", "Daegu", "Daejeon"],
    "IN": ["Mumbai", "Delhi", "Bangalore", "Chennai", "Hyderabad"], "AU": ["Sydney", "Melbourne", "Brisbane", "Perth", "Adelaide"], "CA": ["Toronto", "Vancouver", "Montreal", "Calgary", "Ottawa"],
    "BR": ["São Paulo", "Rio de Janeiro", "Belo Horizonte", "Curitiba", "Porto Alegre"], "MX": ["Mexico City", "Guadalajara", "Monterrey", "Puebla", "Tijuana"], "AE": ["Dubai", "Abu Dhabi", "Sharjah", "Ajman", "Ras Al Khaimah"],
    "SA": ["Riyadh", "Jeddah", "Dammam", "Mecca", "Medina"], "TH": ["Bangkok", "Chiang Mai", "Phuket", "Pattaya", "Khon Kaen"], "MY": ["Kuala Lumpur", "Penang", "Johor Bahru", "Ipoh", "Kota Kinabalu"], "SG": ["Singapore"],
    "ID": ["Jakarta", "Surabaya", "Bandung", "Medan", "Semarang"], "VN": ["Ho Chi Minh City", "Hanoi", "Da Nang", "Hai Phong", "Can Tho"], "PH": ["Manila", "Cebu", "Davao", "Quezon City", "Makati"],
    "TR": ["Istanbul", "Ankara", "Izmir", "Bursa", "Adana"], "PL": ["Warsaw", "Krakow", "Lodz", "Wroclaw", "Poznan"], "ZA": ["Johannesburg", "Cape Town", "Durban", "Pretoria", "Port Elizabeth"],
    "NG": ["Lagos", "Abuja", "Kano", "Ibadan", "Port Harcourt"], "EG": ["Cairo", "Alexandria", "Giza", "Shubra El-Kheima", "Port Said"], "AR": ["Buenos Aires", "Córdoba", "Rosario", "Mendoza", "La Plata"],
    "CL": ["Santiago", "Valparaíso", "Concepción", "Antofagasta", "Viña del Mar"], "CO": ["Bogotá", "Medellín", "Cali", "Barranquilla", "Cartagena"], "PE": ["Lima", "Arequipa", "Trujillo", "Chiclayo", "Piura"],
    "CN": ["Shanghai", "Guangzhou", "Shenzhen", "Beijing", "Chengdu"], "TW": ["Taipei", "Kaohsiung", "Taichung", "Tainan", "Hsinchu"], "HK": ["Hong Kong"], "MO": ["Macau"],
}
# ---- end of fixed values -------------------------------------------------
