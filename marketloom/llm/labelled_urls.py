"""The labelled table for ``url_filter``: urls that are wanted, and urls of gambling, drug, lending, adult, tracking and other junk sites.

Names are made up after what such sites call themselves; none comes from a table that the filter is run on.  The k-th
wanted and the k-th unwanted name stand in the same kind of url, so that scheme, top-level domain and path tell nothing.
"""

from itertools import cycle

WANTED_NAMES = """
gardeningtoday weather-service nationalparks cityhistorymuseum thermal-spa-guide theatre-archive thoughtfulteacher worldheritage
mathematics-education familyrecipes mountainhiking traditional-crafts opensource-project astronomy-station northern-lights-institute
theology-library thesis-collection dictionary-online anthropology-review nutrition-facts birdwatching trainstation-maps
publichealth-agency conservation-trust healthywriting primaryschool-resources chamber-orchestra smallfarmer citycouncil-minutes
organicfarming netherlands-travel cyclingroutes open-data-portal grandmothers-kitchen marine-biology sciencedaily-digest
woodworking-forum poetryfoundation geography-atlas languagelearning constitution-explained northseaferries earthquake-information
fire-brigade-training engineering-handbook orchard-society heathland-walks thunderstorm-radar mothers-and-daughters athletics-results
nineteenth-century-fiction tea-ceremony threadandneedle lighthouse-keepers station-clocks other-voices-radio invention-stories
motion-physics winter-gardens thirteen-colonies thehague thornbury thanet-district thalassa tight-ropes rhythmus
blythe-house thwaites northants growthchart berthold lengthy-essays seventh-street myths-retold booth-records cathedral-choirs
smith-family plymouth-ferry ethnology depths-of-the-sea
""".split()

UNWANTED_NAMES = """
casino-royale-online grand-casino-bonus casinopalace24 bigwin-casino jackpot-slots pokerbonus betnow-sports bestbets24
discount-pills pills-without-prescription viagra-cheap cheapmeds24 pharmacy-discount-rx dietpills-direct adstracker ad-server-7
clicktrack banner-ads-click track-pixel popup-ads-network adclick-tracking payday-loan-fast
instant-loans cheap-loan-now freemoney-now crypto-profit-robot get-rich-quick xxx-videos-free adult-cams-live
hotsingles-tonight porn-tube-hd sexychat-cams replica-watches-shop cheap-watches-outlet cheap-essay-writers lottery-winner
jackpot-winners freespins-daily spamlinks malware-download spam-network linkfarm-seo betting-free-tips
spamblog-generator adultshop-xxx freecasinogames bets-online-now link-farm-directory free-betting-odds ads-and-trackers
cheapest-pills-shop win-real-money casino-winners-club content-farm-spam user-tracking-ads cheap-pharmacy-pills free-bets-offers
farm-of-links tracking-scripts win-at-casinos casino365 slots-free-win poker-win bet-and-win pillstore-cheap cialis-pills
meds-cheap adstat-track cheap-ads-clicks spam-mailer farmspam-seo freebet-club win-a-casino-trip trackads-pro cheap-viagra-pills
spamhost linkspam-farm online-casino-wins betsfree adult-tube
""".split()

#: Kinds of urls: what stands before and behind a name.
FORMS = (
    ("https://www.", ".com/en/12"), ("http://blog.", ".net/de/88.html"), ("https://m.", ".org/en/340"), ("https://", ".org/en/7/"),
    ("http://www.", ".net/de/19?page=2"), ("https://blog.", ".fr/fr/451"), ("https://m.", ".com/en/93#top"), ("http://", ".es/es/205"),
    ("https://www.", ".net/en/610.html"), ("https://blog.", ".org/en/18"), ("http://m.", ".fr/fr/77/"), ("https://", ".de/de/530"),
    ("https://", ".io/en/66?utm_source=feed"),
)

ALLOWED = [f"{front}{name}{back}" for name, (front, back) in zip(WANTED_NAMES, cycle(FORMS))]
BLOCKED = [f"{front}{name}{back}" for name, (front, back) in zip(UNWANTED_NAMES, cycle(FORMS))]
